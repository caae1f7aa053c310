"""Line dedup, Merkle manifest and collocations against brute force on small tables with awkward rows."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from lakesmith.llm import collocations, line_runs, merkle, quotient, ranges

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, pos string, tree string, at long, size long"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table(spark, rows):
    return spark.createDataFrame([(*r, "k", "p", "t", 1, 2) for r in rows], SCHEMA)


LINES = [f"Common line number {k} of the corpus, É{k} long enough" for k in range(12)]


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    made = []
    for i in range(60):
        own = [LINES[k] for k in rng.integers(0, 12, 4)] + [f"own line {i} {'x' * 50}", "short", ""]
        own = ["  " + t.upper() + "\t" if rng.random() < 0.3 else t for t in own]
        made.append((i, "\n".join(own[k] for k in rng.permutation(7)), ["en", "de", None, "fr"][int(rng.integers(0, 4))], "s", 7))
    made += [(100, None, None, None, None), (101, "", "en", "s", 0), (102, "\n\n", "en", "s", 2), (103, "\n".join(f"{LINES[0]} {k % 50}" for k in range(3000)), "de", "s", 1)]
    made += [(59, made[59][1], "en", "s", 7), (59, LINES[3], "en", "s", 7), (None, LINES[0] + "\n" + LINES[1], "en", "s", 7), (None, LINES[0], "xx", "s", 7)]
    return made


def brute_lines(rows, least_chars, least_docs):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOW)
    holders = defaultdict(set)
    for i, text, *_ in rows:
        for line in (text or "").split("\n"):
            if i is not None and len(key(line)) >= least_chars:
                holders[key(line)].add(i)
    common = {k: max(v) for k, v in holders.items() if len(v) >= least_docs}
    out = []
    for i, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [t for t in lines if i is None or not (key(t) in common and i < common[key(t)])]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


@pytest.mark.parametrize("batches,hot", [(1, 1000), (5, 1000), (7, 3)])
def test_common_lines_equal_brute_force(spark, rows, monkeypatch, batches, hot):
    monkeypatch.setattr(line_runs, "HOT_SHARE", hot)
    want = brute_lines(rows, 40, 5)
    got = line_runs.line_report(table(spark, rows), batches=batches).collect()
    assert sum(n for _, _, n, _ in want) > 100
    assert Counter(map(tuple, got)) == Counter((i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in want)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_runs_")]


def test_texts_without_common_lines(spark, rows):
    docs = table(spark, rows)
    got = line_runs.without_common_lines(docs)
    assert got.columns == docs.columns
    want = Counter((i, t) if d else (i, r[1]) for r, (i, _, d, t) in zip(rows, brute_lines(rows, 40, 5), strict=True))
    assert Counter((r.doc_id, r.text) for r in got.collect()) == want
    assert line_runs.line_report(docs.limit(0)).count() == 0


def test_runs_are_compacted_and_keep_counts_and_holders(spark):
    rng = np.random.default_rng(8)
    runs, total, holder = line_runs.LineRuns(spark, 4, fan=3), Counter(), {}
    for batch in range(8):
        own = {f"k{k}".encode(): (int(n), 1000 - batch) for k, n in zip(rng.integers(0, 40, 25), rng.integers(1, 9, 25), strict=True)}
        for k, (n, h) in own.items():
            total[k] += n
            holder.setdefault(k, h)
        runs.add(spark.createDataFrame([(k, *v) for k, v in own.items()], "key binary, docs long, holder long"))
        assert all(len(level) < 3 for level in runs.levels)
        assert {bytes(r.key): (r.docs, r.holder) for r in runs.merged().collect()} == {k: (total[k], holder[k]) for k in total}
    assert [len(level) for level in runs.levels] == [2, 2]
    runs.drop()
    assert runs.merged() is None


def H(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_tree(leaves):
    """All levels, lowest first."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([H(levels[-1][k : k + 8]) for k in range(0, len(levels[-1]), 8)])
    return levels


def brute_leaf(row):
    i, text, lang, source, n = row
    return H("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text))


def brute_manifest(rows):
    groups = defaultdict(list)
    for r in rows:
        chosen = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
        claim = brute_leaf((r[0], r[1].translate(LOW), *r[2:])) if chosen and r[1] is not None else brute_leaf(r)
        groups[r[2]].append(((r[0] is not None, r[0] or 0), brute_leaf(r), claim, r[0]))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in langs:
        groups[g].sort(key=lambda x: (x[0], bytes.fromhex(x[1])))
        trees[g] = brute_tree([leaf for _, leaf, _, _ in groups[g]])
    over = brute_tree([trees[g][-1][0] for g in langs])
    out = []
    for t, g in enumerate(langs):
        for p, (_, leaf, claim, i) in enumerate(groups[g]):
            proof, folded = [], claim
            for levels, at in ((trees[g], p), (over, t)):
                for level in levels[:-1]:
                    run = level[at // 8 * 8 : at // 8 * 8 + 8]
                    before, after = run[: at % 8], run[at % 8 + 1 :]
                    proof += before + after
                    folded = H([*before, folded, *after])
                    at //= 8
            out.append((i, leaf, trees[g][-1][0], over[-1][0], H(proof), folded, folded == over[-1][0]))
    return out


@pytest.mark.parametrize("block", [8, 4096])
def test_manifest_equals_brute_force(spark, rows, monkeypatch, block):
    monkeypatch.setattr(merkle, "BLOCK", block)
    docs = table(spark, rows)
    got = Counter(map(tuple, merkle.manifest(docs, merkle.lowered_claims(docs)).collect()))
    assert got == Counter(brute_manifest(rows))
    assert {v[-1] for v in got} == {True, False}


def test_manifest_of_many_groups_of_one_and_of_none(spark):
    many = [(k, f"T{k}", f"g{k % 70:02d}", None, None) for k in range(100)] + [(5, "x", None, None, None)] * 3
    docs = table(spark, many)
    assert Counter(map(tuple, merkle.manifest(docs, merkle.lowered_claims(docs)).collect())) == Counter(brute_manifest(many))
    one = table(spark, [(7, "Only", "en", "s", 4)])
    assert [tuple(r) for r in merkle.manifest(one).collect()] == [(7, *[brute_leaf((7, "Only", "en", "s", 4))] * 3, H([]), brute_leaf((7, "Only", "en", "s", 4)), True)]
    assert merkle.manifest(docs.limit(0)).count() == 0


def test_rows_are_numbered_over_slices(spark):
    frame = spark.range(5000).selectExpr("(id * 7919) % 5000 AS v").union(spark.range(10).selectExpr("0L"))
    from pyspark.sql import functions as F

    got = sorted((r.v, r.pos) for r in ranges.numbered(frame, [F.col("v")], 13, "test-numbers").collect())
    assert [p for _, p in got] == list(range(5010)) and [v for v, _ in got] == sorted([*range(5000), *[0] * 10])


@pytest.mark.parametrize("count,bits,shards", [(2, 1, 0), (2, 9, 3), (3, 5, 4), (4, 16, 5), (4, 17, 0), (4, 20, 6), (3, 31, 2), (4, 32, 1)])
def test_quotient_filters_give_back_what_they_count(count, bits, shards):
    rng = np.random.default_rng(bits)
    ids = [rng.integers(0, min(2**bits, 3000), 20_000) for _ in range(count)]
    for place in ids:
        place[::4] = place[0]  # a frequent tuple
    layout = quotient.Layout(count, bits, shards)
    want = Counter(zip(*(p.tolist() for p in ids), strict=True))
    halves = [quotient.counted(*layout.permuted([p[s] for p in ids])) for s in (slice(0, 7000), slice(7000, None))]
    kept = defaultdict(list)
    for half in halves:
        assert (np.diff(half[0].astype(object)) >= 0).all()
        for bucket, *rest in quotient.filters(layout, *half):
            kept[bucket].append(quotient.opened(layout, bucket, *rest))
    got = Counter()
    for parts in kept.values():
        top, rest, counts = quotient.counted(*(np.concatenate(c) for c in zip(*parts, strict=True)))
        for row, n in zip(zip(*(p.tolist() for p in layout.restored(top, rest)), strict=True), counts.tolist(), strict=True):
            assert row not in got
            got[row] = n
    assert got == want


def test_numbers_that_share_their_first_64_bits():
    top = np.array([5, 9, 5, 5, 9, 5], np.uint64)
    rest = np.array([2, 1, 1, 2, 1, 1], np.uint64)
    got = quotient.counted(top, rest, np.array([1, 2, 3, 4, 5, 6]))
    assert [a.tolist() for a in got] == [[5, 5, 9], [1, 2, 1], [9, 5, 7]]
    assert [a.tolist() for a in quotient.counted(top, rest)] == [[5, 5, 9], [1, 2, 1], [2, 2, 2]]


def brute_phrases(rows, least, share, most):
    counts, totals = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lang = lang if lang is not None else "und"
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for n in range(1, 5):
                counts[lang].update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, f in counts.items():
        cands = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in cands.items():
            if any(100 * b >= share * a and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in cands.items()):
                continue
            score, _, left, right = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:most], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -s))
    return out


@pytest.fixture(scope="module")
def phrase_rows():
    rng = np.random.default_rng(4)
    words = "the of and Zebra quilt Über naïve don't x\x01 x x\x01y  b 42".split(" ")
    made = []
    for i in range(150):
        text = " ".join(rng.choice(words, int(rng.integers(0, 60)), p=[0.2, 0.2, 0.1] + [0.05] * 10))
        text = text.replace("quilt", "big, red\tbarn door").replace("42", "42.\n" if i % 2 else "new york city hall")
        made.append((i, text, ["en", "de", None, "und", ""][int(rng.integers(0, 5))], "s", 1))
    made += [(200, None, "en", None, None), (201, "", None, None, None), (202, " \t.,", "en", None, None), (203, "la " * 5000, "la", None, None), (203, "la " * 50, "la", None, None)]
    return made


def test_blocks_hold_all_words(phrase_rows, monkeypatch):
    monkeypatch.setattr(collocations, "BLOCK_WORDS", 100)
    batch = pa.RecordBatch.from_pydict({"lang": [r[2] or "und" for r in phrase_rows], "text": [r[1] or "" for r in phrase_rows]})
    blocks = [b.to_pylist()[0] for b in collocations.as_blocks(iter([batch]))]
    assert len(blocks) > 20
    got = Counter()
    for b in blocks:
        codes = np.frombuffer(quotient.CODEC.decompress(b["codes"], 4 * b["n"], asbytes=True), np.int32)
        assert codes[-1] == -1 and Counter(codes[codes >= 0].tolist()) == Counter({k: w["n"] for k, w in enumerate(b["words"])})
        got.update({(w["lang"], w["word"]): w["n"] for w in b["words"]})
    assert got == Counter((r[2] or "und", w) for r in phrase_rows for w in re.findall(r"[^\x20\x09.,;:!?\x0a-\x0d]+", (r[1] or "").translate(LOW)))


@pytest.mark.parametrize("most,merge", [(2000, 1 << 22), (7, 50)])
def test_collocations_equal_brute_force(spark, phrase_rows, monkeypatch, most, merge):
    monkeypatch.setattr(collocations, "MERGE", merge)
    got = collocations.collocations(table(spark, phrase_rows), least=4, share=80, most=most)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute_phrases(phrase_rows, 4, 80, most)
    assert len(want) > 20 and sorted(map(tuple, got.collect())) == sorted(want)


def test_collocations_of_an_empty_table(spark, phrase_rows):
    assert collocations.collocations(table(spark, phrase_rows).limit(0)).count() == 0
    assert collocations.collocations(table(spark, phrase_rows[:1])).count() == 0
