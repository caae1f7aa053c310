"""Each stage's kept ids and texts against plain Python, on planted toxic texts, copies, shared passages and edited leaks."""

import hashlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import tiktoken

from lakesmith.llm import bpe
from lakesmith.session import scratch_path
from tests.llm.test_operators import brute_roots, brute_simhash, words_of

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
INSULTS = ["idiot", "moron", "scum"]
LETTERS = list("abcdefghijklmnopqrstuvwxyz")


def word(rng):
    return "".join(rng.choice(LETTERS, int(rng.integers(3, 9))))


def edited(rng, text, kinds):
    """``text`` with one edit of each kind, far from one another."""
    held = list(text)
    for k, kind in zip(np.linspace(5, len(text) - 5, len(kinds)).astype(int)[::-1].tolist(), kinds, strict=True):
        held[k : k + (kind != "insert")] = [] if kind == "delete" else [str(rng.integers(0, 10))]
    return "".join(held)


@pytest.fixture(scope="module")
def corpus():
    """(documents, labels, benchmark items, planted kinds by id)."""
    rng = np.random.default_rng(31)
    vocabulary = [word(rng) for _ in range(400)]
    some = lambda n: rng.choice(vocabulary, n).tolist()
    passage = [some(25), some(40)]
    items = [" ".join(some(12))[:n].strip() for n in (80, 74, 61, 48, 33)] + [" ".join(some(40))[:100].strip()]
    texts, kinds = [], {}

    def add(kind, words):
        kinds[len(texts)] = kind
        texts.append(words if isinstance(words, str) else " ".join(words))

    for i in range(600):
        add("clean", some(int(rng.integers(40, 90))))
        if i % 5 == 0:
            own = some(50)
            for insult in INSULTS:
                own.insert(int(rng.integers(0, 50)), insult)
            add("toxic", own)
    for k in range(12):
        add("copy", texts[6 * k + 2].title() if k % 2 else texts[6 * k + 2])
        near = texts[6 * k + 3].split(" ")
        near[k] = "other"
        add("near", near)
    for k in range(24):
        at = int(rng.integers(0, 30))
        own = some(60)
        add("passage", own[:at] + passage[k % 2] + own[at:])
    add("passage", "\n ".join(passage[0]) + "\n")
    for item in items:
        budget = int(min(80, len(item)) * 0.0625)
        for n in range(budget + 3):
            changes = [str(rng.choice(["insert", "delete", "change"])) for _ in range(n)]
            add("leak", " ".join(some(30)) + " " + edited(rng, item, changes).title() + " " + " ".join(some(20)))
    add("leak", " ".join(some(30)) + " " + items[5][5:92] + " " + " ".join(some(20)))
    add("empty", "")
    texts.append(None)
    kinds[len(texts) - 1] = "null"
    docs = [(i, t, "en" if i % 3 else None, "hot", None if t is None else len(t)) for i, t in enumerate(texts)]
    return docs, [(i, 1, int(kinds[i] == "toxic")) for i in kinds], list(enumerate(items)), kinds


@pytest.fixture(scope="module")
def stages(spark, corpus):
    """The rows before and after each stage, by the pipeline's own functions."""
    docs, labels, items, _ = corpus
    folder = scratch_path(spark, "test-brute-pipeline")
    spark.createDataFrame(docs, DOCS).repartition(4).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    found, frame = {}, spark.read.parquet(f"{folder}/documents.parquet")
    before = {r.doc_id: r for r in frame.collect()}
    for name, stage in corpus_pipeline.STAGES:
        frame = corpus_pipeline.staged(stage(spark, frame, folder), f"test-brute-{name}")
        rows = frame.collect()
        after = {r.doc_id: r for r in rows}
        assert len(rows) == len(after), name
        found[name], before = (before, after), after
    return found


def test_toxic_documents_go_and_clean_ones_stay(stages, corpus):
    before, after = stages["toxicity"]
    toxic = {i for i, kind in corpus[3].items() if kind == "toxic"}
    assert set(before) - set(after) == toxic
    assert all(after[i] == before[i] for i in after)


def test_one_document_of_each_group_of_near_copies_stays(stages, corpus):
    before, after = stages["simhash"]
    fps = {i: brute_simhash(r.text) for i, r in before.items()}
    roots = brute_roots(fps, [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 2])
    assert set(after) == set(roots.values()) and all(after[i] == before[i] for i in after)
    assert {i for i, kind in corpus[3].items() if kind == "copy"}.isdisjoint(after)


def test_words_of_repeated_windows_go_and_documents_stay(stages):
    before, after = stages["substrings"]
    first, cut = {}, 0
    for i in sorted(before):
        w = words_of(before[i].text)
        for k in range(len(w) - 12):
            first.setdefault(tuple(w[k : k + 13]), i)
    for i, row in before.items():
        w = words_of(row.text)
        gone = {k + j for k in range(len(w) - 12) if first[tuple(w[k : k + 13])] < i for j in range(13)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone) if gone else row.text
        cut += bool(gone)
        assert after[i].text == kept and after[i].n_chars == (len(kept) if gone else row.n_chars), i
        assert (after[i].lang, after[i].source) == (row.lang, row.source)
    assert set(after) == set(before) and cut >= 20


def least_edits(item, text):
    """Least edits of the whole item against any stretch of the text."""
    codes, place = np.array(list(map(ord, text))), np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, int)
    for k, c in enumerate(item):
        now = row + 1
        now[1:] = np.minimum(now[1:], row[:-1] + (codes != ord(c)))
        now[0] = k + 1
        row = np.minimum.accumulate(now - place) + place
    return int(row.min())


def test_documents_that_hold_a_benchmark_passage_go(stages, corpus):
    before, after = stages["decontamination"]
    leaked = set()
    for i, row in before.items():
        text = (row.text or "").lower()
        for _, item in corpus[2]:
            parts = [item] if len(item) <= 80 else [item[k : k + 80] for k in range(len(item) - 79)]
            if any(least_edits(p, text) <= int(len(p) * 0.0625) for p in parts):
                leaked.add(i)
    assert set(before) - set(after) == leaked
    assert len(leaked) >= 20 and {corpus[3][i] for i in leaked} == {"leak"}
    assert {i for i in before if corpus[3][i] == "leak"} - leaked  # beyond the budget
    assert all(after[i] == before[i] for i in after)


def test_ids_of_what_is_left(stages):
    before, after = stages["byte_bpe"]
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert set(after) == set(before)
    for i, row in after.items():
        text = before[i].text or ""
        ids = library.encode_ordinary(text)
        assert row.ids == ids and row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
