"""The operators of lakesmith.llm against brute force on small tables with awkward rows."""

import base64
import hashlib
import io
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakesmith.llm import bpe, components, decontaminate, language, parsing, simhash, substrings, token_files, toxicity, url_filter, warc
from lakesmith.llm.queries import RULES

WORDS = "the of and zebra quilt Über naïve don't 42 x-y. hello, WORLD!! the of".split()
DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp long, __ranges string"


def prose(seed: int, n: int) -> str:
    rng = np.random.default_rng(seed)
    return " ".join(str(w) + str(k % 7) * int(k % 3 == 0) for w, k in zip(rng.choice(WORDS, n).tolist(), rng.integers(0, 1000, n).tolist(), strict=True))


@pytest.fixture(scope="module")
def texts():
    base = [prose(i, 20 + 7 * i) for i in range(12)]
    shared = prose(99, 40)
    made = [None, "", " \n\t ", "one", "two words", "É\u00a0x\u2003y 'tis it's  a\r\nb\x0bc", "a " * 3000, "日本語 テキスト。", "\U0001f600" * 5]
    made += base + [base[3], base[3] + " tail", shared + " " + base[5], base[6] + "\n" + shared, shared]
    return made


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", "s", 0, i, "extra") for i, t in enumerate(texts)]
    rows += [(3, texts[3], None, None, None, None, None), (None, texts[12], None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_simhash(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    w = words_of(low)
    if not w:
        return 0
    shingles = [" ".join(w)] if len(w) < 3 else [" ".join(w[i : i + 3]) for i in range(len(w) - 2)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_simhash_and_components(spark, docs, texts, empty):
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(texts) + 2
    fps = {i: brute_simhash(t) for i, t in enumerate(texts)}
    links = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 2]
    roots = brute_roots(fps, links)
    for r in got:
        if r.doc_id is not None:
            assert r.fingerprint == f"{fps[r.doc_id]:016x}" and r.component_id == roots[r.doc_id]
    kept = sorted(r.doc_id for r in simhash.one_of_each(docs).collect() if r.doc_id is not None)
    assert kept == sorted({roots[i] for i in fps})
    assert simhash.one_of_each(docs).columns == docs.columns
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("crowded", [512, 1])
def test_simhash_links_equal_brute_force(spark, monkeypatch, crowded):
    """Clusters of near fingerprints; with a threshold of 1 all cells take the way of crowded ones."""
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    rng = np.random.default_rng(5)
    base = rng.integers(-(2**63), 2**63 - 1, 20, dtype=np.int64).view(np.uint64)
    fps = {int(b) for b in base}
    for b in base[:8]:
        for _ in range(25):
            fps.add(int(b) ^ sum(1 << int(k) for k in rng.choice(12, int(rng.integers(0, 4)), replace=False)))
    signed = [int(np.uint64(f).astype(np.int64)) for f in sorted(fps)]
    frame = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = {r.node: r.root for r in components.connected(simhash.links(frame)).collect()}
    brute = brute_roots(signed, [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 2])
    assert {f: got.get(f, f) for f in signed} == brute


def test_components_of_a_long_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5), (None, 3), (2, 1)]
    got = {r.node: r.root for r in components.connected(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(301)}, **{1000 + i: 1000 for i in range(200)}}
    assert components.connected(spark.createDataFrame([], "u long, v long")).count() == 0


def test_language(spark, empty):
    rng = np.random.default_rng(1)
    stems = {"en": "the and with this from have that", "de": "der und nicht sein auch über wird", "fr": "les des pour dans être cette avec", "es": "los para como esta pero más una"}
    rows = []
    for i in range(400):
        lang = list(stems)[i % 4]
        rows.append((i, " ".join(rng.choice(stems[lang].split(), 12)), lang, "s", 0, 0, ""))
    rows += [(1000, None, "en", "s", 0, 0, ""), (1001, "12 !!", "en", "s", 0, 0, ""), (1002, "", None, None, None, None, None), (None, "und der nicht", None, None, None, None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    model = language.learn(docs)
    got = language.identify(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    truth = {r[0]: r[2] for r in rows}
    held = [r for r in got if r.held_out and r.doc_id < 400]
    assert held and all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in held)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97
    assert {r.lang_pred for r in got if r.doc_id in (1000, 1001, 1002)} == {"und"}
    assert next(r for r in got if r.doc_id is None).lang_pred == "de"
    assert language.identify(docs, language.learn(empty)).where("lang_pred != 'und'").count() == 0
    assert language.identify(empty, model).count() == 0


def test_url_filter(spark):
    urls = [
        "http://example.com/en/x", "https://WWW.Example.com/en/?q", "http://a.b.example.net/es/1", "http://net/fr/", "http://net/fr", "x", None, "", "http://", "http://example.com",
        "http://notexample.com/en/1", "http://example.com.evil.org/en/1", "http://example.com?x=/en/", "http://example.com/en", "http://user@example.com/en/", "a://b://c.com/",
    ]
    pages = spark.createDataFrame([(i, u, "h", 1, "k") for i, u in enumerate([*urls, *urls])] + [(None, urls[0], "h", 1, "k")], "page_id long, url string, host string, key int, keys string")
    got = url_filter.judge_urls(pages, RULES).collect()
    assert len(got) == 2 * len(urls) + 1
    for r in got:
        url = urls[r.page_id % len(urls)] if r.page_id is not None else urls[0]
        rest = url.partition("://")[2] if url and "://" in url else ""
        host, path = re.match(r"([^/?#]*)([^?#]*)", rest).groups()
        host = host.lower()
        fits = [x for x in RULES if (host == x.host or host.endswith("." + x.host)) and path.startswith(x.path)]
        best = max(fits, key=lambda x: len(x.key), default=None)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, best and best.key, best.verdict if best else "allow"), url
    assert url_filter.judge_urls(pages.limit(0), RULES).count() == 0
    assert url_filter.judge_urls(pages, []).where("verdict != 'allow' OR rule IS NOT NULL").count() == 0


def test_bloom_cascade_is_exact_on_its_universe(spark):
    universe = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"))
    keys = [f"k{i}" for i in range(0, 3000, 3)]
    levels = url_filter.build_cascade(universe, keys, 20_000)
    pairs = url_filter._pairs(universe.select(*url_filter._hashes(F.col("key"))).collect())
    found = url_filter.cascade_has(levels, pairs)
    assert [f"k{i}" for i in np.flatnonzero(found)] == sorted(keys, key=lambda k: int(k[1:]))
    assert sum(b.size for b in levels) < 40 * len(keys)


def test_parsing(spark, docs, texts, empty):
    got = parsing.edited_likeness(docs).collect()
    ordered = sorted(((i, t or "") for i, t in [*enumerate(texts), (3, texts[3]), (-(2**63), texts[12])]), reverse=True)
    expect = Counter()
    for k, (i, t) in enumerate(ordered):
        after = ordered[(k + 1) % len(ordered)][1]
        changed = parsing.edited(t, after)
        a, b, c = (parsing.signatures([x.encode()])[0] for x in (t, changed, after))
        doc = None if i == -(2**63) else i
        expect[doc, len(t), hashlib.sha256(changed.encode()).hexdigest(), parsing.fingerprint_text(a), parsing.fingerprint_text(b), parsing.likeness(a, b), parsing.likeness(a, c)] += 1
    assert Counter(tuple(r) for r in got) == expect
    assert parsing.edited_likeness(empty).count() == 0
    assert {r.fingerprint for r in parsing.fingerprints(docs).where("doc_id = 0").collect()} == {""}


def test_parsing_is_locally_consistent():
    """A long common part gives common names at whatever offset it stands."""
    common, names = prose(7, 900), []
    for lead in ("", "x", "some other words before "):
        names.append(set(parsing.signatures([(lead + common).encode()])[0].tolist()))
    assert len(names[0] & names[1]) > 0.9 * len(names[0]) and len(names[0] & names[2]) > 0.9 * len(names[0])
    assert not set(parsing.signatures([prose(8, 900).encode()])[0].tolist()) >= names[0]


def test_decontamination(spark, empty):
    items = [(0, prose(50, 30)), (1, prose(51, 18)), (2, None), (3, "short"), (4, "x" * 200)]
    bench = spark.createDataFrame([(i, t, "z") for i, t in items], "item_id long, text string, doc_id string")
    item = items[0][1]
    rng = np.random.default_rng(3)
    changed = list(item)
    for k in range(10, len(item) - 10, 40):
        changed[k] = "#"
    cases = {
        "clean": prose(60, 300), "whole": prose(61, 50) + "\n" + item + " " + prose(62, 50), "upper": item.upper(), "part": prose(63, 20) + item[5:105] + prose(64, 20),
        "edited": prose(65, 30) + "".join(changed) + prose(66, 30), "too short": prose(67, 20) + " " + item[:60], "null": None, "empty": "", "shuffled": " ".join(rng.permutation(item.split())),
        "second": items[1][1] + prose(68, 30) + items[1][1],
    }
    names = list(cases)
    docs = spark.createDataFrame([(i, cases[n], "en", "s", 0, 0, "") for i, n in enumerate(names)] + [(1, cases["whole"], None, None, None, None, None)], DOCS)
    got = decontaminate.find_leaks(docs, bench).collect()
    assert {(names[r.doc_id], r.item_id) for r in got} == {("whole", 0), ("upper", 0), ("part", 0), ("edited", 0), ("second", 1)}
    assert Counter(names[r.doc_id] for r in got) == {"whole": 2, "upper": 1, "part": 1, "edited": 1, "second": 2}
    whole = next(r for r in got if names[r.doc_id] == "whole")
    assert cases["whole"][whole.start : whole.end] == item and whole.edits == 0
    blocks = decontaminate.find_leaks(docs, bench, block_chars=100).collect()
    assert Counter(map(tuple, blocks)) == Counter(map(tuple, got))
    kept = decontaminate.without_leaks(docs, bench)
    assert kept.columns == docs.columns and sorted(names[r.doc_id] for r in kept.collect()) == sorted(["clean", "too short", "null", "empty", "shuffled"])
    assert decontaminate.find_leaks(empty, bench).count() == 0 and decontaminate.find_leaks(docs, bench.limit(0)).count() == 0


def test_band_edits_equals_edit_distance():
    rng = np.random.default_rng(9)
    for _ in range(30):
        item = rng.integers(0, 4, 30).astype(np.uint32)
        text = np.delete(np.insert(item, rng.integers(0, 30, 2), 9), rng.integers(0, 30, 2)).astype(np.uint32)
        best = np.arange(len(text) + 1) * 0
        for k in range(len(item)):
            now = [best[0] + 1]
            for j in range(len(text)):
                now.append(min(best[j] + (text[j] != item[k]), best[j + 1] + 1, now[-1] + 1))
            best = np.array(now)
        assert decontaminate.band_edits(item, text, np.array([0]), 30, -30, 30)[0] == best.min()


@pytest.mark.parametrize("size, edits", [(31, 1), (40, 2), (60, 3), (81, 4), (81, 5), (120, 5)])
def test_leaks_of_edited_items_at_all_offsets(size, edits):
    """Insertions, deletions and changes up to the budget, wherever they fall in the bands, against edit distance."""
    rng = np.random.default_rng(size + edits)
    letters = list("abcdefghijklmnopqrstuvwxyz ")
    item = "".join(rng.choice(letters, size))
    length = min(size, decontaminate.STRETCH)
    budget, items = int(length * decontaminate.EDIT_RATE), decontaminate.Items.of([(0, item)])
    texts, leaked, least = [], [], []
    for kind in ("insert", "delete", "change", "mixed"):
        for n in (edits, budget + 1):
            for offset in range(12):
                lead, changed = "".join(rng.choice(letters, 100 + offset)), list(item)
                for k in np.linspace(0, size - 1, n + 2).astype(int)[-2:0:-1].tolist():
                    how = kind if kind != "mixed" else str(rng.choice(["insert", "delete", "change"]))
                    changed[k : k + (how != "insert")] = [] if how == "delete" else ["#"]
                texts.append(lead + "".join(changed) + "".join(rng.choice(letters, 100)))
                own, codes = decontaminate.characters(texts[-1]), decontaminate.characters(item)
                whole = [decontaminate.band_edits(codes, own, np.array([s]), length, -size, len(own))[0] for s in range(size - length + 1)]
                leaked.append(min(whole) <= budget)
                least.append(min(whole))
    got = decontaminate.leaks(texts, items)
    assert [row for row, *_ in got] == [i for i, x in enumerate(leaked) if x] and sum(leaked) >= 48
    assert [e for *_, e in got] == [least[row] for row, *_ in got]


def test_short_items_leak_whole_and_word_bounded(spark):
    items = {0: "The Answer", 1: "42", 2: " - ", 3: "", 4: None, 5: "nineteen characters", 6: "東京都庁", 7: "42"}
    texts = ["it is the answer: 42", "the answers 421 x42", "42", "THE\tANSWER", "nineteen characterz", "nineteen characters!", "彼は東京都庁にいる", "", None, "4", "2 - the answer"]
    expect = {(0, 0, 6, 16), (0, 1, 18, 20), (0, 7, 18, 20), (2, 1, 0, 2), (2, 7, 0, 2), (3, 0, 0, 10), (4, 5, 0, 19), (5, 5, 0, 19), (6, 6, 2, 6), (10, 0, 4, 14)}  # at 16 to 19 characters one edit is in the budget
    docs, bench = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string"), spark.createDataFrame([*items.items()], "item_id long, text string")
    got = decontaminate.find_leaks(docs, bench).collect()
    assert len(got) == len(expect) and {(r.doc_id, r.item_id, r.start, r.end) for r in got} == expect and {r.doc_id for r in got if r.edits} == {4}
    assert {r.doc_id for r in decontaminate.without_leaks(docs, bench).collect()} == {1, 7, 8, 9}


def levenshtein_within(item, text):
    """Least edits of the item against any stretch of the text, by the whole table."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item):
        now = [i + 1]
        for j, b in enumerate(text):
            now.append(min(row[j] + (a != b), row[j + 1] + 1, now[j] + 1))
        row = now
    return min(row)


@pytest.mark.parametrize("size", [10, 15, 16, 17, 19, 20, 31, 40])
def test_short_and_middling_items_with_all_budgets(size):
    rng = np.random.default_rng(size)
    letters = list("abcdefghijklmnop")
    missed = 0
    for _ in range(60):
        item = "".join(rng.choice(letters, size))
        held = list(item)
        for _ in range(int(rng.integers(0, int(size * decontaminate.EDIT_RATE) + 2))):
            at = int(rng.integers(0, len(held)))
            kind = int(rng.integers(0, 3))
            held[at : at + (kind != 1)] = [] if kind == 0 else [str(rng.choice(letters))]
        text = "qrst uvw, " + "".join(held) + " xyz qrs"
        edits = levenshtein_within(item, text)
        if size * decontaminate.EDIT_RATE < 1 and f" {item} " not in text:
            edits = 1  # no edit in the budget: whole and between word ends
        got = decontaminate.leaks([text], decontaminate.Items.of([(0, item)]))
        if edits <= int(size * decontaminate.EDIT_RATE):
            assert len(got) == 1 and got[0][4] <= int(size * decontaminate.EDIT_RATE), (item, text)
        else:
            missed += 1
            assert not got, (item, text, edits)
    assert missed


def test_texts_of_blanks_rules_and_indents_take_linear_time():
    import time

    rng = np.random.default_rng(2)
    names = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz_"), int(rng.integers(4, 12)))) for _ in range(3000)]
    line = lambda: " " * 4 * int(rng.integers(0, 9)) + " ".join(rng.choice(names, 3)) + ":" + " " * 12 + "#" + "-" * int(rng.integers(0, 60))
    code = lambda n: "\n".join(line() for _ in range(n))
    bench = [(k, code(8)) for k in range(200)]
    text = code(20_000)
    planted = text + "\n" + bench[7][1].replace("\n", "\r\n\t")
    items = decontaminate.Items.of(bench)
    began = time.time()
    got = decontaminate.leaks([text, planted, " " * 200_000, "-" * 200_000], items)
    assert len(text) > 10**6 and time.time() - began < 60
    assert any(r == 1 and k == 7 and start > len(text) - 5 for r, k, start, *_ in got)
    assert not [g for g in got if g[0] in (2, 3)]


def test_hits_in_portions_find_the_same(monkeypatch):
    rng = np.random.default_rng(9)
    words = [f"w{k}" for k in range(40)]
    bench = [(k, " ".join(rng.choice(words, 30))) for k in range(12)]
    texts = [" ".join(rng.choice(words, 50)) + " " + bench[k % 12][1] + " " + " ".join(rng.choice(words, 50)) for k in range(20)]
    items = decontaminate.Items.of(bench)
    want = decontaminate.leaks(texts, items)
    for most in (10, 300):
        monkeypatch.setattr(decontaminate, "MOST_HITS", most)
        assert decontaminate.leaks(texts, items) == want and len(want) >= 20


def test_token_files(spark, docs, texts, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    rows = [(i, library.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in [(-1, texts[12]), *enumerate(texts), (3, texts[3])]]
    rows.sort(key=lambda r: (r[0], np.array(r[1], "<u2").tobytes()))
    expect, start = [], 0
    for i, ids in rows:
        expect.append((None if i < 0 else i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = token_files.pack_documents(spark, docs, path, end_id=2).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expect
    assert token_files.pack_documents(spark, empty, path, end_id=2).count() == 0


def test_added_tokens_in_a_text_are_encoded_as_the_library_does():
    path = public_tokenizers.path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), token_files.WordEncoder(path)
    texts = ["", "plain words", "a<|startoftext|>B", "Über <|endoftext|> é!", "<|EndOfText|> <|endoftext|", "<|startoftext|><|endoftext|>"]
    expect = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert {49406, 49407} <= {i for ids in expect for i in ids}
    assert [np.frombuffer(x, "<u4").tolist() for x in own.encode([t.encode() for t in texts], 2)] == [[*ids, 2] for ids in expect]


class _Source(io.BytesIO):
    def size(self):
        return len(self.getvalue())

    def read_at(self, n, at):
        return self.getvalue()[at : at + n]


@pytest.mark.parametrize("bits", [1, 7, 13, 16, 17, 32])
def test_packing_and_random_access(bits):
    rng = np.random.default_rng(bits)
    docs = [rng.integers(0, 2**bits, int(n), dtype=np.uint64).astype(np.uint32) for n in rng.integers(0, 400, 40)]
    out = _Source()
    writer = token_files.FileWriter(out, bits, block=64)
    for k, d in enumerate(docs):
        writer.add(np.array([k]), np.array([len(d)]), d)
    assert writer.close() == (40, sum(map(len, docs)))
    reader = token_files.FileReader(out)
    flat = np.concatenate(docs)
    for _ in range(60):
        a, b = sorted(rng.integers(0, len(flat) + 1, 2))
        assert (reader.ids(int(a), int(b)) == flat[a:b]).all()
    ids, ends = reader.index(5, 9)
    assert ids.tolist() == [5, 6, 7, 8] and ends.tolist() == np.cumsum([len(d) for d in docs])[5:9].tolist()
    assert token_files.bits_for(49408) == 16 and token_files.bits_for(65537) == 17 and token_files.bits_for(1) == 1


@pytest.mark.parametrize("hot", [64, 1])
def test_substring_dedup(spark, docs, texts, empty, monkeypatch, hot):
    """With a threshold of 1, repeated strings take the way of very common ones."""
    monkeypatch.setattr(substrings, "HOT", hot)
    rows = [*enumerate(texts), (3, texts[3]), (None, texts[12])]
    least = {}
    for i, t in rows:
        w = words_of(t)
        for k in range(len(w) - 12):
            if i is not None:
                key = tuple(w[k : k + 13])
                least[key] = min(least.get(key, i), i)
    expect = Counter()
    for i, t in rows:
        w = words_of(t)
        gone = [False] * len(w)
        for k in range(len(w) - 12):
            if i is not None and least[tuple(w[k : k + 13])] < i:
                gone[k : k + 13] = [True] * 13
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        expect[i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    got = substrings.removed_words(docs).collect()
    assert Counter(map(tuple, got)) == expect and sum(r.n_removed for r in got) > 50
    cut = substrings.without_repeats(docs)
    assert cut.schema == docs.schema and cut.count() == docs.count()
    assert substrings.removed_words(empty).count() == 0


def test_substring_dedup_under_changing_blocks(spark, monkeypatch):
    """A passage that is hot in the blocks of the first job, and would not be in those of any later one."""
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, write = spark.conf.get(batch), substrings.staged

    def staged(df, name, *more):
        out = write(df, name, *more)
        spark.conf.set(batch, "10")
        return out

    monkeypatch.setattr(substrings, "staged", staged)
    passage = prose(70, 100)
    docs = spark.createDataFrame([(i, f"lead{i} {passage} tail{i}") for i in range(100)], "doc_id long, text string").coalesce(1)
    try:
        got = {r.doc_id: r.n_removed for r in substrings.removed_words(docs).collect()}
    finally:
        spark.conf.set(batch, before)
    assert got == {i: 100 * (i > 0) for i in range(100)}


def test_toxicity(spark, empty):
    rng = np.random.default_rng(2)
    rows, labels = [], []
    for i in range(900):
        toxic = i % 6 == 0
        words = list(rng.choice(["alpha", "beta", "gamma", "delta", "omega"], 30))
        for k in range(3 * toxic):
            words.insert(int(rng.integers(0, 30)), ["idiot", "M0R0N", "sc*um!!"][k])
        rows.append((i, " ".join(words), "en", "s", 0, 0, ""))
        labels.append((i, 1, int(toxic)))
    rows += [(5000, None, None, None, None, None, None), (5001, "", None, None, None, None, None), (None, "idiot moron scum alpha", None, None, None, None, None)]
    docs, marks = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels + [(7, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.learn(docs, marks)
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out and r.doc_id < 900]
    assert np.mean([r.predicted == int(r.doc_id % 6 == 0) for r in held]) > 0.97
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted == 0 for r in got)
    nothing = toxicity.learn(docs, marks.limit(0))
    assert {r.score for r in toxicity.score(docs, nothing).collect()} == {0.0}
    assert toxicity.score(empty, model).count() == 0


def test_learning_takes_one_row_of_a_repeated_id(spark, monkeypatch):
    """The bounds on learned rows hold if one chosen id stands in most rows."""
    rows = [(i, f"the and with {'idiot ' * (i % 3 == 0)}alpha{i}", "en" if i % 2 else "de") for i in range(30)]
    rows += [(k, f"the and this from {n % 5}", "en" if k % 2 else "de") for k in (1, 3, 4) for n in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = [i for i in range(30) if zlib.crc32(str(i).encode()) % 4 != 2]
    assert set(learned) & {1, 3, 4}
    sizes = []
    monkeypatch.setattr(language.LanguageModel, "fit", lambda x, langs: sizes.append(len(x)))
    language.learn(docs)
    monkeypatch.setattr(toxicity.Trees, "fit", lambda x, y: sizes.append(len(y)) or toxicity.Trees())
    monkeypatch.setattr(toxicity, "isotonic", lambda margin, y: sizes.append(len(y)))
    toxicity.learn(docs, spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(30)], "doc_id long, toxic int"))
    assert sizes[0] == sum(sizes[1:]) == len(learned)


def test_isotonic_is_monotone_and_pools():
    at, p = toxicity.isotonic(np.array([1.0, 2, 3, 4, 5]), np.array([0.0, 1, 0, 1, 1]))
    assert (np.diff(p) >= 0).all() and np.interp(2.5, at, p) == 0.5 and np.interp(0, at, p) == 0


def test_warc(spark):
    htmls = ["<p>a</p>", "<p>a</p>", None, "", "é\r\n\r\nWARC/1.1\r\n", "<p>b</p>", "<p>a</p>", "x" * 300_000]
    rows = [(i, f"http://h/{i}\n", h, "k") for i, h in enumerate(htmls)] + [(6, "u", "<p>a</p>", "k"), (None, None, "<p>a</p>", "k")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string")
    got = warc.archive_pages(spark, pages).collect()
    assert len(got) == len(rows)
    best = {}
    for i, _, h, _ in rows:
        if i is not None:
            best[h or ""] = max(best.get(h or "", -1), i)
    responses = Counter()
    for r in got:
        h = (htmls[r.page_id] if r.page_id is not None else "<p>a</p>") or ""
        assert r.payload_bytes == len(h.encode()) and r.payload_digest == base64.b32encode(hashlib.sha1(h.encode()).digest()).decode()
        responses[h] += r.record_type == "response"
        assert r.refers_to == (None if r.record_type == "response" else best[h])
        assert r.record_type == "revisit" or r.page_id == best[h]
    assert set(responses.values()) == {1}
    assert warc.archive_pages(spark, pages.limit(0)).count() == 0


def test_warc_splits_own_each_record_once():
    rng = np.random.default_rng(4)
    payloads = [rng.integers(0, 256, int(n), dtype=np.uint8).tobytes() + b"\x1f\x8b\x08" * 20 for n in rng.integers(0, 3000, 60)]
    data = b"".join(warc.record(i, None, p, hashlib.sha1(p).digest(), None, level=0) for i, p in enumerate(payloads))
    for step in (1, 97, 5000, 10**9) if len(data) < 10**5 else (97, 5000, 10**9):
        got = [warc.parse_record(r)["payload"] for a in range(0, len(data), step) for r in warc.read_split(_Source(data), len(data), a, min(len(data), a + step))]
        assert got == payloads


def test_warc_keeps_long_headers_and_null_ids(spark):
    """A url of 2 MiB, half of the ids null, and equal rows."""
    rows = [(None if i % 2 else i, "http://h/" + "u" * (2 << 20) * (i == 4), f"payload {i % 7}") for i in range(60)] + [(58, "same", "payload 2")] * 2500
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    got = warc.archive_pages(spark, pages).collect()
    best = {}
    for i, _, h in rows:
        best[h] = max(best.get(h, -1), -1 if i is None else i)
    want = Counter()
    for h, top in best.items():
        want[(top, h, "response", None)] += 1
    for i, _, h in rows:
        want[(i, h, "revisit", best[h])] += 1
    for h, top in best.items():
        want[(top, h, "revisit", top)] -= 1
    sha = {base64.b32encode(hashlib.sha1(h.encode()).digest()).decode(): h for h in best}
    assert Counter((r.page_id, sha[r.payload_digest], r.record_type, r.refers_to) for r in got) == +want
    small = Counter((r.page_id, r.record_type) for r in warc.read_archives(warc.write_archives(pages, warc.scratch_uri(spark, "small"), least_bytes=100), warc.scratch_uri(spark, "small")).collect())
    assert small == Counter((i, "response") for i, _, _ in rows)


def test_warc_raises_on_damaged_records():
    rng = np.random.default_rng(11)
    parts = [warc.record(i, None, rng.integers(0, 256, 3000, dtype=np.uint8).tobytes(), b"x" * 20, None) for i in range(3)]
    whole = b"".join(parts)
    at = len(parts[0])
    read = lambda data: list(warc.read_split(_Source(data), len(data), 0, len(data)))
    assert len(read(whole)) == 3
    for damaged in (whole[: at + 1500] + b"\x55" * 500 + whole[at + 2000 :], whole[:-700], whole[: at + 60]):
        with pytest.raises(ValueError, match="byte"):
            read(damaged)


def test_letters_by_unicode_category():
    assert not any(map(language.has_letter, ["", "12 !!", "½ ² Ⅷ ٣", "\u0301\u0308", "_", "😀"]))
    assert all(map(language.has_letter, ["½a", "é", "日", "ª", "Ⅷ ж"]))


def test_byte_bpe(spark, docs, texts, empty):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    got = bpe.encode_documents(docs, path, public_tokenizers.PATTERN).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        text = (texts[r.doc_id] if r.doc_id is not None else texts[12]) or ""
        ids = library.encode_ordinary(text)
        assert r.ids == ids and r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.encode_documents(empty, path, public_tokenizers.PATTERN).count() == 0


def test_replay_goes_back_to_lower_ranks():
    """A merge that brings up a pair of a lower rank: the order of one match alone is kept."""
    ranks = {bytes([c]): c - 97 for c in b"abcd"} | {b"bc": 10, b"abc": 5, b"cd": 7, b"ab": 12, b"bcd": 6}

    def alone(word):
        parts = [word[i : i + 1] for i in range(len(word))]
        while True:
            found = min(((ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks), default=None)
            if found is None:
                return [ranks[p] for p in parts]
            i = found[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    rng = np.random.default_rng(6)
    words = [bytes(rng.choice(list(b"abcd"), int(n)).tolist()) for n in rng.integers(0, 12, 400)]
    assert bpe.replay(words, ranks) == [alone(w) for w in words]
