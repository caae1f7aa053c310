"""Parsing against a slow parse, symbol by symbol, and tables of which half the rows have no id, over several slices."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakesmith.llm import parsing, token_files

ALL = 2**64 - 1
STEP, MIX = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9


def mixed(x):
    x = ((x ^ (x >> 30)) * MIX) & ALL
    return x ^ (x >> 27)


def tossed(labels):
    """Each label's lowest bit that differs from its left neighbour's, twice that and the bit's value."""
    found = [labels[0] & 1]
    for left, own in zip(labels, labels[1:], strict=False):
        bit = 0
        while not (left ^ own) >> bit & 1:
            bit += 1
        found.append(2 * bit + (own >> bit & 1))
    return found


def slow_levels(text: bytes):
    """The phrase names of each level."""
    symbols, levels = list(text), []
    while symbols:
        runs = []
        for s in symbols:
            if runs and runs[-1][0] == s:
                runs[-1][1] += 1
            else:
                runs.append([s, 1])
        labels = [s for s, _ in runs]
        for _ in range(4 if levels else 3):
            labels = tossed(labels)
        names = [mixed((s * STEP + n + (len(levels) << 40)) & ALL) for s, n in runs]
        phrases = []
        for i, name in enumerate(names):
            inside = 1 < i < len(names) - 1
            if i == 0 or inside and labels[i - 1] < labels[i] >= labels[i + 1]:
                phrases.append([])
            phrases[-1].append(name)
        symbols = [mixed((sum(mixed((n + k * STEP) & ALL) for k, n in enumerate(p, 1)) & ALL) ^ (len(p) * STEP & ALL)) for p in phrases]
        levels.append(symbols)
        if len(symbols) == 1:
            break
    return levels


def slow_signature(text: str):
    """The names of levels 3 and above, of lower ones too until there are 16, cut to 32 bits."""
    levels = slow_levels(text.encode())
    for lowest in range(min(3, len(levels)) - 1, -1, -1):
        if lowest == 0 or sum(map(len, levels[lowest:])) >= 16:
            return sorted({mixed(n) >> 32 for level in levels[lowest:] for n in level})[:64]
    return []


def slow_likeness(a, b):
    if not a or not b:
        return float(a == b)
    least = sorted({*a, *b})[:64]
    j = len({*a} & {*b} & {*least}) / len(least)
    return 2 * j / (1 + j)


def made(n):
    """Every second row without an id; some texts, ids and whole rows repeat, some are empty or NULL."""
    rng = np.random.default_rng(17)
    words = "alpha beta gamma delta epsilon zeta eta Θήτα iota 漢字 mu nu".split()
    texts = [" ".join(rng.choice(words, int(k)).tolist()) for k in rng.integers(0, 60, n)]
    texts[5], texts[6], texts[8] = None, "a" * 3000, texts[10]
    rows = [(None if i % 2 else int(i) // 6 * 6, t) for i, t in enumerate(texts)]
    return [*rows, rows[7], rows[8]]


@pytest.mark.parametrize("text", ["", "a", "ab", "aaaa", "abcabc", "naïve 漢字 \n\t", "xy" * 500, "the quick brown fox " * 40, "".join(map(chr, range(32, 900)))])
def test_signature_equals_a_slow_parse(text):
    assert parsing.signatures([text.encode()])[0][:64].tolist() == slow_signature(text)


def test_parsing_with_half_the_ids_null(spark):
    rows = made(600)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    ordered = sorted(((-(2**63) if i is None else i, (t or "").encode()) for i, t in rows), reverse=True)
    ordered = [(None if i == -(2**63) else i, t.decode()) for i, t in ordered]
    expect, known = Counter(), {}
    sign = lambda t: known.setdefault(t, slow_signature(t))
    for (i, t), (_, after) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        half = len(t) // 2
        changed = t[: len(t) - half] + after[:half]
        hexed = [b"".join(n.to_bytes(4, "big") for n in sign(x)).hex() for x in (t, changed)]
        near = slow_likeness(sign(t), sign(changed)), slow_likeness(sign(t), sign(after))
        expect[i, len(t), hashlib.sha256(changed.encode()).hexdigest(), *hexed, *near] += 1
    assert Counter(map(tuple, parsing.edited_likeness(docs).collect())) == expect
    slices = parsing.in_order(docs).groupBy(F.spark_partition_id()).count().collect()
    assert len(slices) >= 6 and max(r["count"] for r in slices) < 0.3 * len(rows)


def test_token_files_with_half_the_ids_null(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    library, rows = Tokenizer.from_file(path), made(600)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    ids = [(i, library.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in rows]
    ids.sort(key=lambda r: (-(2**63) if r[0] is None else r[0], np.array(r[1], "<u2").tobytes()))
    expect, start = [], 0
    for i, own in ids:
        expect.append((i, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        start += len(own)
    folder = token_files.scratch_uri(spark, "test-null-ids")
    manifest = token_files.write_token_files(docs, folder, path, end_id=2)
    got = token_files.read_token_files(manifest, folder).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expect
    sizes = [r.n_docs for r in manifest.collect()]
    assert sum(sizes) == len(rows) and max(sizes) < 0.3 * len(rows)
