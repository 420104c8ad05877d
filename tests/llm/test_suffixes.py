"""Repeated byte strings against a set of all strings in plain Python."""

import hashlib
import os

import numpy as np
import pytest

from moodgauge.llm import suffixes
from moodgauge.llm.tables import table
from moodgauge.session import scratch_path

SF_DIR = "/root/testdata/sf0.001"


def plain(rows, length):
    seen, out = set(), []
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        raw = (text or "").encode()
        flags = bytearray(len(raw))
        for k in range(len(raw) - length + 1):
            if raw[k : k + length] in seen:
                flags[k : k + length] = b"\1" * length
            seen.add(raw[k : k + length])
        kept = bytes(x for x, flag in zip(raw, flags) if not flag)
        spans = sum(flags[k] and not (k and flags[k - 1]) for k in range(len(raw)))
        out.append((i, len(raw), sum(flags), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(docs, **options):
    names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    return sorted((tuple(r[n] for n in names) for r in suffixes.without_repeats(docs, **options).collect()), key=str)


@pytest.mark.parametrize("length, unit", [(20, 20), (20, 10), (20, 2), (60, 2)])
def test_repeats(spark, length, unit):
    """Small units need names of names, as three symbols are fewer bytes than a string."""
    rng = np.random.default_rng(1)
    rows = [(k, "".join(rng.choice(["a", "b", "é"], int(rng.integers(0, 300))))) for k in range(20)]
    rows += [(k + 30, rows[k][1][5:90] + "!" + rows[k + 1][1][40:]) for k in range(10)]
    rows += [(40, "ab" * 300), (41, "ab" * 300), (42, None), (None, "ab" * 50), (43, "x" * 30), (44, "x" * 19), (45, "")]
    docs = spark.createDataFrame([(i, t, 1, 2, "s") for i, t in rows], "doc_id long, text string, start int, g int, locator string")
    assert found(docs, length=length, unit=unit) == plain(rows, length)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are not here")
def test_given_table(spark):
    docs = table(spark, SF_DIR, "documents")
    assert found(docs) == plain([(r.doc_id, r.text) for r in docs.collect()], 100)


@pytest.mark.parametrize("hot_keys", [1, 20, 1 << 14])
def test_copies_and_shared_passages(spark, monkeypatch, hot_keys):
    """Copies, near copies, passages in different surroundings and periods, with none, some and all phrases hot."""
    monkeypatch.setattr(suffixes, "HOT_KEYS", hot_keys)
    rng = np.random.default_rng(2)
    word = lambda n: " ".join("".join(rng.choice(list("abcdeé"), 4)) for _ in range(n))
    base, passage = word(120), word(30)
    rows = [(k, base) for k in range(12)]
    for k in range(20, 40):
        at = int(rng.integers(0, len(base)))
        rows += [(k, base[:at] + "#" + base[at + 3 :]), (k + 100, word(15) + passage[k % 7 :] + word(15))]
    rows += [(200, "ab" * 200 + passage), (201, "x" * 350 + "ab" * 90), (202, passage + "x" * 160), (203, base[40:]), (None, base + passage)]
    docs = spark.createDataFrame([rows[k] for k in rng.permutation(len(rows))], "doc_id long, text string")
    assert found(docs) == plain(rows, 100)


def test_many_runs_of_one_document_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "BROADCAST_RUNS", 3, raising=False)
    rng = np.random.default_rng(4)
    passages = ["".join(rng.choice(list("abcdefgh"), 30)) for _ in range(5)]
    rows = [(k, text) for k, text in enumerate(passages)] + [(9, "".join(f"{text}!{k}?" for k, text in enumerate(passages)))]
    docs = spark.createDataFrame([(i, t, str(i)) for i, t in rows], "doc_id long, text string, locator string")
    out = suffixes.without_repeats(docs, length=20, unit=10)
    assert "strategy=broadcast" not in out._jdf.queryExecution().analyzed().toString()
    assert [(r.n_spans, r.n_removed) for r in out.filter("doc_id = 9").collect()] == [(5, 150)]


def test_phrases_partition_windows():
    """Every window within a text lies in one phrase, and the windows of a phrase have one anchor."""
    rng = np.random.default_rng(3)
    texts = [bytes(rng.integers(97, 100, n, dtype=np.uint8)) for n in (0, 19, 20, 300)] + [b"ab" * 60, b"x" * 90]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.append(0, np.cumsum([len(t) for t in texts]))
    first, size, anchor, _ = suffixes.phrases(data, offsets, 20)
    windows = np.concatenate([np.arange(a, a + n) for a, n in zip(first, size)])
    assert windows.tolist() == [k for a, b in zip(offsets, offsets[1:]) for k in range(a, b - 19)]
    halves = suffixes.place_hashes(data, 10)
    for a, n, least in zip(first, size, anchor):
        assert {k + int(np.argmin(halves[k : k + 11])) for k in range(a, a + n)} == {a + int(np.argmin(halves[a : a + 11]))}
        assert halves[a : a + 11].min() == least


def test_empty_and_single(spark):
    docs = spark.createDataFrame([(1, "a" * 150), (2, None)], "doc_id long, text string")
    assert found(docs) == plain([(1, "a" * 150), (2, None)], 100)
    assert found(docs.limit(0)) == []
    with pytest.raises(ValueError):
        suffixes.repeats(docs, length=100, unit=30)


def test_sliding():
    rng = np.random.default_rng(0)
    for n, window in ((1, 1), (7, 3), (9, 3), (50, 7), (3, 5)):
        values = rng.integers(0, 9, n).astype(np.uint64)
        assert suffixes.sliding(values, window, np.minimum, 99).tolist() == [values[k : k + window].min() for k in range(n - window + 1)]


def some_rows(rng):
    """Neighbours share most of a text, some texts share a passage with far ones; ids come twice and are missing."""
    word = lambda n: " ".join("".join(rng.choice(list("abcdeé"), 4)) for _ in range(n))
    passages, rows = [word(30) for _ in range(3)], []
    for k in range(80):
        base = word(40)
        rows += [(k // 2, base + passages[k % 3][k % 5 :]), (k // 2 if k % 4 else None, base[20:150] + "!" + base[:90])]
    return rows


def test_each_group_of_slices_has_bitmaps_of_its_own(spark, monkeypatch):
    """The bitmaps of a group hold the repeats that stand in it, not those of all texts, and the result is that of one group."""
    path = scratch_path(spark, "grouped")
    rows = some_rows(np.random.default_rng(5))
    spark.createDataFrame(spark.sparkContext.parallelize(rows, 40), "doc_id long, text string").write.parquet(path)
    docs, fills, made = spark.read.parquet(path), [], suffixes.bitmap

    def kept(hashes):
        out = made(hashes)
        fills.append(int(np.unpackbits(out).sum()))
        return out

    monkeypatch.setattr(suffixes, "bitmap", kept)
    one = found(docs)
    assert len(fills) == 4
    monkeypatch.setattr(suffixes, "SLICES", 3, raising=False)
    monkeypatch.setattr(suffixes, "GROUP_PLACES", 1, raising=False)
    assert found(docs) == one
    grouped = fills[4:]
    assert len(grouped) == 12
    for all_of, parts in zip(fills, (grouped[0:6:2], grouped[1:6:2], grouped[6:9], grouped[9:])):
        assert all_of <= sum(parts)
    assert max(grouped[0:6:2]) < 0.9 * fills[0]
    assert max(grouped[6:9]) < 0.9 * fills[2]


def test_repeats_in_groups_and_rounds(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "FOLD_ROWS", 1, raising=False)
    monkeypatch.setattr(suffixes, "SLICES", 4, raising=False)
    monkeypatch.setattr(suffixes, "GROUP_PLACES", 1, raising=False)
    rows = [(k, text) for k, (_, text) in enumerate(some_rows(np.random.default_rng(6))[:60])] + [(None, "ab" * 80), (90, "ab" * 90), (91, None)]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, 20), "doc_id long, text string")
    assert found(docs) == plain(rows, 100)


def test_bitmap_lets_few_others_through(spark):
    rng = np.random.default_rng(7)
    given, others = (rng.integers(-(1 << 63), 1 << 63, n) for n in (2000, 1 << 20))
    held = suffixes.bitmap(spark.createDataFrame([(int(x),) for x in given], "hash long"))
    assert suffixes.among(held, given.view(np.uint64)).all()
    assert not suffixes.among(held, others.view(np.uint64)).any()


def test_scan_of_a_group_leaves_other_files_out(spark):
    path = scratch_path(spark, "files")
    spark.range(0, 1200, 1, 12).write.parquet(path)
    table = spark.read.parquet(path)
    some = table.select("id", suffixes.slice_of_file(table).alias("slice")).filter("slice % 4 = 1")
    assert sorted(r.slice for r in some.select("slice").distinct().collect()) == [1, 5, 9]
    scan = some._jdf.queryExecution().sparkPlan().collectLeaves().head()
    assert scan.selectedPartitions().totalNumberOfFiles() == 3
