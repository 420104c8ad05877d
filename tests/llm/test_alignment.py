"""Alignment of two tokenizers against plain Python."""

import collections
import hashlib
import os

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from moodgauge.llm import alignment, catalog
from moodgauge.llm import text as tx

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are not here")

COLUMNS = "doc_id long, text string, n_a string, pairs string, row string, pair string, times string, n_best int, x int"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, *[None] * 7) for i, t in rows], COLUMNS)


@pytest.fixture(scope="module")
def sides():
    path_a, path_b = alignment.tokenizer_paths()
    a, b = Tokenizer.from_file(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
    a.encode_special_tokens = True
    return a, b, alignment.ByteTokens(path_a).entries


def plain_tokens(sides, text):
    """[(id, end)] of both sides, or two empty lists."""
    a, b, entries = sides
    if not text:
        return [], []
    of_a = [(i, entries[i]) for i in a.encode(" " + text, add_special_tokens=False).ids]
    of_b = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        of_b.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    if any(b"".join(x for _, x in side) != (" " + text).encode() for side in (of_a, of_b)):
        return [], []
    out = []
    for side in (of_a, of_b):
        at, ends = 0, []
        for i, raw in side:
            at += len(raw)
            ends.append((i, at))
        out.append(ends)
    return out


def expected(sides, rows, relation="end"):
    every, counts = [], collections.Counter()
    for doc_id, text in rows:
        a, b = plain_tokens(sides, text)
        where = {end: i for i, end in b}
        if relation == "end":
            links = [(i, where[end]) for i, end in a if end in where]
        else:
            spans = [[(i, begin, end) for (i, end), begin in zip(side, [0, *(e for _, e in side)])] for side in (a, b)]
            links = [(i, j) for i, p, q in spans[0] for j, r, s in spans[1] if p < s and r < q]
        both = {end for _, end in a} & set(where)
        parts, begin = [], 0
        for end in sorted(both):
            parts.append("|".join(",".join(str(i) for i, e in side if begin < e <= end) for side in (a, b)))
            begin = end
        counts.update(links)
        every.append((doc_id, len(a), len(b), len(both), links, hashlib.sha256(";".join(parts).encode()).hexdigest() if a else ""))
    highest = {}
    for (_, j), n in counts.items():
        highest[j] = max(highest.get(j, 0), n)
    return sorted(
        ((d, na, nb, g, len(links), sum(counts[x] == highest[x[1]] for x in links), sum(counts[x] for x in links), h) for d, na, nb, g, links, h in every), key=str
    )


ODD = [
    (1, "plain words, and some more"), (1, "plain words, and some more"), (None, "a  b   c \n d\te f g"), (3, None), (4, ""), (5, " "), (6, "  two"), (7, "end \n"),
    (8, "it's we'll '' I'M <|endoftext|> <s> </s> <unk> <0x41>"), (9, "a ▁ b"), (10, "日本語 テキスト 🙂🙂 é ﬁ"), (11, "\x00\x01 \r\n\r\n x"), (12, "word " * 300),
    (13, "x" * 500), (14, "Ñandú über Ökonomie × ÷ é è"), (15, "1234567 3.14 a1b2 C3PO"), (16, " x \u0085y  z"), (17, "é a ñ  b"),
]


def test_query_against_plain_python(spark, sides):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    got = catalog.QUERIES["op12_token_alignment"](spark, SF_DIR).collect()
    assert sorted(map(tuple, got), key=str) == expected(sides, rows)


@pytest.mark.parametrize("relation", ["end", "overlap"])
@pytest.mark.parametrize("head", [1 << 20, 20, 0])
def test_odd_texts(spark, sides, relation, head):
    docs = docs_of(spark, ODD).repartition(3)
    got = alignment.alignment(docs, relation=relation, head_pairs=head).collect()
    assert sorted(map(tuple, got), key=str) == expected(sides, ODD, relation)
    assert alignment.alignment(docs_of(spark, []), relation=relation, head_pairs=head).collect() == []


def test_random_texts_keep_the_tokenizers_ids(sides):
    rng = np.random.default_rng(5)
    letters = list("abcXYZ  \n\t'.,-1 9éñß×÷ ▁日🙂|<>") + ["́", "\u0085", "  ", " the ", "​", "ǅ"]
    texts = ["".join(rng.choice(letters, rng.integers(1, 40))) for _ in range(3000)]
    parts = alignment.Parts(alignment.tokenizer_paths())
    data, offsets = alignment.with_space(*tx.flat(pa.array(texts)))
    ((ids_a, n_a), (ids_b, n_b)), whole = parts.encode(data, offsets)
    at_a, at_b = np.append(0, np.cumsum(n_a)), np.append(0, np.cumsum(n_b))
    for k, text in enumerate(texts):
        a, b = plain_tokens(sides, text)
        assert ids_a[at_a[k] : at_a[k + 1]].tolist() == [i for i, _ in a], repr(text)
        assert ids_b[at_b[k] : at_b[k + 1]].tolist() == [i for i, _ in b], repr(text)
        assert whole[k] == bool(a)


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 64, 10_000])
def test_pieces_merge_to_the_same_overlaps(piece):
    rng = np.random.default_rng(piece)
    for _ in range(30):
        last = int(rng.integers(1, 200))
        a, b = (np.unique(np.append(rng.integers(1, last + 1, rng.integers(0, last + 1)), last)) for _ in range(2))
        got = alignment.stitched(alignment.merge_path(a, b, piece))
        ends = np.union1d(a, b)
        assert got.a.tolist() == np.searchsorted(a, ends).tolist()
        assert got.b.tolist() == np.searchsorted(b, ends).tolist()
        assert got.together.tolist() == (np.isin(ends, a) & np.isin(ends, b)).tolist()


def test_pieces_have_equal_work():
    a, b = np.arange(1, 1001) * 3, np.append(np.arange(1, 301), 3000)
    diagonals = np.append(np.arange(0, len(a) + len(b), 100), len(a) + len(b))
    of_a = alignment.crossings(a, b, diagonals)
    assert (np.diff(of_a) + np.diff(diagonals - of_a) <= 100).all()


def test_a_long_text(spark, sides):
    text = " ".join(f"{k}th" for k in range(1_200_000))
    assert len(text) > 8_000_000
    got = alignment.alignment(docs_of(spark, [(1, text), (2, "short one")]).filter("doc_id > 0")).collect()
    a, b = plain_tokens(sides, text)
    row = {r.doc_id: r for r in got}[1]
    assert (row.n_a, row.n_b, row.n_groups) == (len(a), len(b), len({e for _, e in a} & {e for _, e in b}))
