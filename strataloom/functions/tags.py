"""Splitting one list of free-form tags into typed model attributes."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .vocabulary import LIBRARIES, language_codes, task_names


@dataclass(frozen=True)
class TagVocabulary:
    languages: tuple[str, ...]
    libraries: tuple[str, ...]
    tasks: tuple[str, ...]

    @classmethod
    def standard(cls, spark: SparkSession, strict: bool = False) -> TagVocabulary:
        """The built-in dictionaries.

        Tags are compared in lower case.  ``strict`` compares them with the
        entries as spelled, so only entries already in lower case can match;
        otherwise entries are turned into tag form first.
        """
        form = (lambda name: name) if strict else tag_form
        return cls(
            languages=language_codes(spark),
            libraries=tuple(map(form, LIBRARIES)),
            tasks=tuple(map(form, task_names())),
        )


def tag_form(name: str) -> str:
    return name.lower().replace(" ", "-")


def _any_of(text: Column, entries: Iterable[str]) -> Column:
    return text.isin(*entries)


def _or_null(items: Column) -> Column:
    return F.nullif(items, F.array().cast("array<string>"))


def _last(items: Column) -> Column:
    return F.try_element_at(items, F.lit(-1))


def known_tags(tags: Column, vocabulary: TagVocabulary) -> Column:
    """The tags that an entry of the vocabulary may fit, in order: one look-up for each.

    Most tags have a prefix; where no entry has a colon, these are not looked up.
    """
    entries = {*map(str.lower, vocabulary.languages), *vocabulary.libraries, *vocabulary.tasks}

    def fits(t: Column) -> Column:
        found = _any_of(F.lower(t), sorted(entries))
        return found if any(":" in e for e in entries) else ~F.contains(t, F.lit(":")) & found

    return F.filter(tags, fits)


def tag_groups(tags: Column, vocabulary: TagVocabulary) -> dict[str, Column]:
    """Short lists of tags, in order, that the rules of ``tag_columns`` look through.

    Plain tags of the vocabulary; dataset, deploy and diffusers tags begin with a d; the
    others have a prefix too.  Each list is one pass over all tags, and the rules that
    share it need no further one.
    """
    return {
        "known": known_tags(tags, vocabulary),
        "d_tags": F.filter(tags, lambda t: t.startswith("d")),
        "others": F.filter(tags, lambda t: F.contains(t, F.lit(":")) & ~t.startswith("d")),
    }


def tag_columns(
    known: Column, d_tags: Column, others: Column, vocabulary: TagVocabulary
) -> dict[str, Column]:
    """Eleven attributes by name; the first rule that fits a tag takes it.

    Plain tags are tried as language (case-sensitive), library and task; prefixed
    tags by their prefix.  The last licence, region and diffusers tag wins, the
    first deploy tag wins, arxiv tags are counted and the rest, NULLs included, is
    dropped.  Membership tests are hash look-ups and each attribute is one pass
    over one of the ``tag_groups``.
    """

    def is_language(t: Column) -> Column:
        return _any_of(t, vocabulary.languages)

    def is_library(t: Column) -> Column:
        return _any_of(F.lower(t), vocabulary.libraries) & ~is_language(t)

    def is_task(t: Column) -> Column:
        lowered = F.lower(t)
        return (
            _any_of(lowered, vocabulary.tasks)
            & ~is_language(t)
            & ~_any_of(lowered, vocabulary.libraries)
        )

    def with_prefix(prefix: str) -> Column:
        group = d_tags if prefix.startswith("d") else others
        return F.filter(group, lambda t: t.startswith(prefix))

    def after(prefix: str, tag: Column) -> Column:
        return F.substr(tag, F.lit(len(prefix) + 1))

    def last_after(prefix: str) -> Column:
        return after(prefix, _last(with_prefix(prefix)))

    bases = with_prefix("base_model:")
    base_names = F.transform(
        F.transform(bases, lambda t: F.split(t, ":")),
        lambda p: F.when(F.size(p) > 2, F.get(p, F.lit(2))).otherwise(F.get(p, F.lit(1))),
    )
    # The second of three parts or more; only the tag it is taken from is cut.
    modified = F.filter(bases, lambda t: F.contains(after("base_model:", t), F.lit(":")))

    return {
        "language": _or_null(F.filter(known, is_language)),
        "library": _or_null(F.transform(F.filter(known, is_library), F.lower)),
        "task": _or_null(F.transform(F.filter(known, is_task), F.lower)),
        "license": last_after("license:"),
        "base_models": _or_null(F.sort_array(F.array_distinct(base_names))),
        "modification": F.substring_index(after("base_model:", _last(modified)), ":", 1),
        "region": last_after("region:"),
        "diffusers_pipeline": last_after("diffusers:"),
        "deploy": after("deploy:", F.get(with_prefix("deploy:"), F.lit(0))),
        "dataset": _or_null(
            F.transform(with_prefix("dataset:"), lambda t: after("dataset:", t))
        ),
        "arxiv": F.coalesce(F.size(with_prefix("arxiv:")), F.lit(0)),
    }


def classify_tags(tags: Column, vocabulary: TagVocabulary) -> Column:
    """Struct of the attributes of ``tag_columns``."""
    found = tag_columns(**tag_groups(tags, vocabulary), vocabulary=vocabulary)
    return F.struct(*[column.alias(name) for name, column in found.items()])


def extract_owner(model_id: Column) -> Column:
    """The part before the first ``/``; NULL when there is none."""
    return F.when(F.contains(model_id, F.lit("/")), F.substring_index(model_id, "/", 1))
