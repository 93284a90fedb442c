import random
import re
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import public_tokenizers
from helpers import clashing, corpus, frame
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from strataloom.llm import alignment

TEXTS = "doc_id long, text string"


def plain_bytes():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names = {b: chr(b) for b in plain}
    names |= {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in plain)}
    return {c: b for b, c in names.items()}


class Plain:
    """Groups and links token by token."""

    def __init__(self):
        self.a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
        self.byte = plain_bytes()

    def bytes_b(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", piece) else piece.replace("▁", " ").encode()

    def groups(self, text):
        if not text:
            return []
        found = self.a.encode(" " + text, add_special_tokens=False)
        a = [(i, bytes(self.byte[c] for c in t)) for i, t in zip(found.ids, found.tokens)]
        b = [(i, self.bytes_b(i)) for i in self.b.encode(text)]
        if not b"".join(x for _, x in a) == b"".join(x for _, x in b) == (" " + text).encode():
            return []
        out, group, at_a, at_b = [], ([], []), 0, 0
        while a or b:
            if at_a <= at_b:
                i, x = a.pop(0)
                at_a += len(x)
                group[0].append(i)
            else:
                i, x = b.pop(0)
                at_b += len(x)
                group[1].append(i)
            if at_a == at_b:
                out.append(group)
                group = ([], [])
        return out

    def rows(self, docs):
        found = [(doc_id, self.groups(text)) for doc_id, text in docs]
        links = [Counter((x, y) for a, b in g for x in a for y in b) for _, g in found]
        held = Counter(pair for own in links for pair in own)
        top = defaultdict(int)
        for (x, _), n in held.items():
            top[x] = max(top[x], n)
        out = []
        for (doc_id, g), own in zip(found, links):
            text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
            out.append((
                doc_id, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), own.total(),
                sum(n for p, n in own.items() if held[p] == top[p[0]]), sum(n * held[p] for p, n in own.items()),
                sha256(text.encode()).hexdigest() if g else "", text,
            ))
        return sorted(map(repr, out))


def texts():
    rng = random.Random(3)
    odd = [
        "", None, " ", "\n", "  two  spaces ", "<|endoftext|> is text, <s> too </s>", "▁ underline", "a▁b",
        "zürich 中文字符 \U0001f642\U0001f680 café é", "x" * 900, "ab" * 700, "<0x41> A \x00 \x7f",
        " nbsp　wide", "".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(300)), "1234567890" * 30,
        "def f(x):\n\treturn x  # tab\r\n",
    ]
    rows = [(i, t) for i, (_, t, *_) in enumerate(corpus(60, 8))]
    rows += [(500 + i, t) for i, t in enumerate(odd)]
    rows += [(None, "no id"), (None, None), rows[0], rows[0]]
    return rows


def test_against_plain_version(spark):
    rows = texts()
    want = Plain().rows(rows)
    small = alignment.Settings(work=7, chunk=2000, wide=4)
    for settings in (alignment.Settings(), small):
        out = alignment.alignments(frame(spark, rows, TEXTS).repartition(3), settings)
        assert sorted(repr(tuple(r)) for r in out.collect()) == want
    out = alignment.alignments(frame(spark, rows, TEXTS), with_groups=False)
    assert all(r.groups is None or not r.n_a for r in out.collect())


def test_pieces_of_any_size_give_the_same_cuts():
    rng = np.random.default_rng(4)
    for _ in range(40):
        n = int(rng.integers(1, 400))
        a, b = (np.unique(np.append(rng.integers(0, n, rng.integers(1, n + 1)), n)) for _ in "ab")
        want = [(i, j) for i, x in enumerate(a.tolist()) for j, y in enumerate(b.tolist()) if x == y]
        for work in (1, 2, 3, 10, 1000):
            assert list(zip(*map(np.ndarray.tolist, alignment.common_ends(a, b, work)))) == want
            at = np.arange(0, len(a) + len(b) + 1, work)
            merged = sorted([(x, 0) for x in a.tolist()] + [(x, 1) for x in b.tolist()])
            assert alignment.diagonals(a, b, at).tolist() == [sum(s == 0 for _, s in merged[:d]) for d in at]


def test_empty_and_clashing(spark):
    assert alignment.alignments(frame(spark, [], TEXTS)).count() == 0
    assert [tuple(r)[1:] for r in alignment.alignments(frame(spark, [(1, "")], TEXTS), with_groups=False).drop("groups").collect()] == [
        (0, 0, 0, 0, 0, 0, "")]
    rows = [(i, f"text {i} of some words", "en", "s", 1) for i in range(20)]
    wide = clashing(frame(spark, rows))
    wide = wide.selectExpr("*", *[f"'x' AS {c}" for c in ("chunk", "pairs", "n_a", "which", "docs", "a", "b", "n", "best")])
    assert sorted(repr(tuple(r)) for r in alignment.alignments(wide).collect()) == Plain().rows([r[:2] for r in rows])
