"""Each operator against a brute-force version, on odd rows, and on empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import public_tokenizers
from tidemark.llm import bpe, components, decontamination, exact_dedup, language_id, simhash, substring_dedup, suffix_array, token_ids, toxicity, warc
from tidemark.storage import new_folder

from .conftest import ROWS

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def lower(text):
    return (text or "").encode().lower().decode()


def test_exact(odd, none):
    out = exact_dedup.exact_dedup(odd)
    groups = {}
    for i, t in ROWS:
        groups.setdefault(lower(t), []).append(i)
    want = []
    for i, t in ROWS:
        own = groups[lower(t)]
        keep = max((x for x in own if x is not None), default=None)
        want.append((i, keep, len(own), keep == i, hashlib.sha256(lower(t).encode()).hexdigest()))
    assert got(out, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == sorted(want, key=str)
    assert out.first()["body"] == "own body" and exact_dedup.exact_dedup(none).count() == 0
    kept = exact_dedup.keep_first(odd)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} == {5, 7, 9, 11, 12, 13, None}


def test_exact_with_equal_digests(spark, monkeypatch):
    """Texts that share a digest are still told apart by their content."""
    real = F.sha2
    monkeypatch.setattr(exact_dedup.F, "sha2", lambda c, n: real(F.lit("x"), n))
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "A")], "doc_id long, text string")
    assert got(exact_dedup.exact_dedup(df), "doc_id", "keep_id", "group_size") == [(1, 3, 2), (2, 2, 1), (3, 3, 2)]


def test_bpe(spark, odd, none, library):
    out = {(r.doc_id, r.decoded): list(r.ids) for r in bpe.bpe_encode(odd, PATH).collect()}
    for i, t in ROWS:
        assert out[i, t or ""] == library.encode(t or "", add_special_tokens=False).ids
    assert bpe.bpe_digests(none).count() == 0
    rng, own = random.Random(1), bpe.encoder(PATH)
    for _ in range(3000):
        t = "".join(rng.choice("ab 'st\n\t\r é日1２<|>!. \x1c\x1f end") for _ in range(rng.randint(0, 40)))
        ids = own.encode(t)
        assert ids == library.encode(t, add_special_tokens=False).ids and own.decode(ids) == library.decode(ids, skip_special_tokens=False)
    assert own.decode([own.single[0xE9]]) == "�"


def marked(text):
    """The hash by which rows of an id are ordered, as a signed number."""
    return int.from_bytes(xxhash.xxh64_digest((text or "").encode(), 42), "big", signed=True)


def test_token_ids(spark, odd, none, library):
    folder = new_folder(spark, "test")
    token_ids.write_token_ids(odd, folder, PATH)
    rows = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, marked(r[1]), r[1] or ""))
    back = token_ids.read_token_ids(spark, folder).orderBy("start").collect()
    at = 0
    for (i, t), r in zip(rows, back, strict=True):
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        assert (r.id, r.start, r.n_tokens, list(r.ids)) == (i, at, len(ids), ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        at += len(ids)
    assert token_ids.read_document(spark, folder, 13).tolist() == library.encode(ROWS[-1][1], add_special_tokens=False).ids + [2]
    assert token_ids.read_document(spark, folder, 99) is None
    empty = new_folder(spark, "test")
    token_ids.write_token_ids(none, empty, PATH)
    assert token_ids.read_token_ids(spark, empty).count() == 0
    block = token_ids.pack([(1, 1, b"")], bytes(32), False)
    with pytest.raises(ValueError, match="another dictionary"):
        token_ids.Block(block, b"x")


def brute_bytes(rows, width):
    seen = Counter(b[k : k + width] for _, t in rows for b in [(t or "").encode()] for k in range(len(b) - width + 1))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, dtype=np.int8)
        for k in range(len(b) - width + 1):
            if seen[b[k : k + width]] > 1:
                gone[k : k + width] = 1
        kept = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        out.append((i, len(b), len(b) - len(kept), int((np.diff(gone) == 1).sum() + (gone[0] == 1)), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def brute_words(rows, width):
    first = {}
    low = lambda i: -(1 << 63) if i is None else i
    for i, t in rows:
        w = (t or "").encode().split()
        for k in range(len(w) - width + 1):
            x = tuple(w[k : k + width])
            first[x] = min(first.get(x, 1 << 62), low(i))
    out = []
    for i, t in rows:
        w = (t or "").encode().split()
        gone = set()
        for k in range(len(w) - width + 1):
            if first[tuple(w[k : k + width])] < low(i):
                gone |= {*range(k, k + width)}
        out.append((i, len(w), len(gone), hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in gone)).hexdigest()))
    return sorted(out, key=str)


def passages(seed):
    rng, rows = random.Random(seed), []
    for i in range(40):
        parts = ["".join(rng.choice("ab ") for _ in range(rng.randint(0, 60))) for _ in range(3)]
        rows.append((i, " ".join(rng.choice(rows)[1] if rows and rng.random() < 0.4 else p for p in parts)[:400]))
    return [*rows, (40, "a" * 200), (41, None), (42, "a b " * 60), (None, "a b " * 60), (7, "a b " * 60), (7, "ab ba " * 20)]


@pytest.mark.parametrize("split", [1, 4, 1000])
def test_substrings(spark, split):
    rows = passages(split)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    one = suffix_array.suffix_array_dedup(df, window=24, split=split)
    assert got(one, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_bytes(rows, 24)
    two = substring_dedup.substring_dedup(df, window=6, split=split)
    assert got(two, "doc_id", "n_words", "n_removed", "kept_sha256") == brute_words(rows, 6)


def test_substrings_of_odd_rows(odd, none):
    assert got(suffix_array.suffix_array_dedup(odd, texts=False), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_bytes(ROWS, 200)
    assert got(substring_dedup.substring_dedup(odd, texts=False), "doc_id", "n_words", "n_removed", "kept_sha256") == brute_words(ROWS, 50)
    assert suffix_array.suffix_array_dedup(none).count() == 0 and substring_dedup.substring_dedup(none).count() == 0


def test_substrings_of_null_ids_with_equal_hashes(spark):
    """Texts without an id are told apart although a 32-bit hash of them is equal."""
    def mixed(h, k):
        k = (k * 0xCC9E2D51) & 0xFFFFFFFF
        k = (((k << 15) | (k >> 17)) * 0x1B873593) & 0xFFFFFFFF
        h ^= k
        return (((h << 13) | (h >> 19)) * 5 + 0xE6546B64) & 0xFFFFFFFF

    # Two texts of 256 bytes whose murmur3 hashes meet: their last words are chosen among many.
    rng, alphabet, seen = random.Random(4), "abcdefghijklmnopqrstuvwxyz", {}
    heads = ["".join(rng.choice(alphabet) for _ in range(248)) for _ in range(2)]
    states = []
    for head in heads:
        h = 42
        for k in range(0, 248, 4):
            h = mixed(h, int.from_bytes(head[k : k + 4].encode(), "little"))
        states.append(h)
    pair = None
    while pair is None:
        tail = "".join(rng.choice(alphabet) for _ in range(8))
        which = rng.randint(0, 1)
        h = states[which]
        for k in (0, 4):
            h = mixed(h, int.from_bytes(tail[k : k + 4].encode(), "little"))
        other = seen.setdefault(h, (which, tail))
        if other[0] != which:
            pair = {which: tail, other[0]: other[1]}
    a, b = heads[0] + pair[0], heads[1] + pair[1]
    df = spark.createDataFrame([(None, a), (None, b), (1, a)], "doc_id long, text string")
    assert df.select(F.hash("text").alias("h")).distinct().count() == 1
    out = {(r.doc_id, r.kept_sha256): r.n_removed for r in suffix_array.suffix_array_dedup(df, texts=False).collect()}
    assert out[None, hashlib.sha256(b.encode()).hexdigest()] == 0 and sorted(out.values()) == [0, 256, 256]


def test_substrings_of_repeated_rows(spark):
    """Rows that repeat all are copies, and the work on them grows in proportion."""
    words = " ".join(f"w{k}" for k in range(400))
    for n in (200, 800):
        df = spark.createDataFrame([(7, words)] * n + [(9, words), (8, "x " * 30)], "doc_id long, text string").repartition(4)
        one = {(r.doc_id, r.n_removed) for r in suffix_array.suffix_array_dedup(df, texts=False).collect()}
        two = {(r.doc_id, r.n_removed) for r in substring_dedup.substring_dedup(df, texts=False).collect()}
        assert one == {(7, len(words)), (9, len(words)), (8, 0)} and two == {(7, 0), (9, 400), (8, 0)}


def test_substrings_of_long_periodic_texts(spark):
    df = spark.createDataFrame([(1, "a" * 300_000), (2, "b c " * 60_000), (3, "b c " * 20)], "doc_id long, text string")
    assert got(suffix_array.suffix_array_dedup(df, texts=False), "doc_id", "n_removed", "n_spans") == [(1, 300_000, 1), (2, 240_000, 1), (3, 0, 0)]
    assert got(substring_dedup.substring_dedup(df, texts=False), "doc_id", "n_words", "n_removed") == [(1, 1, 0), (2, 120_000, 0), (3, 40, 0)]


def test_suffix_array():
    """The array against sorted suffixes, and repeated windows against counting."""
    rng = random.Random(3)
    for turn in range(150):
        width, segments = rng.choice([8, 9, 24, 200]), []
        for _ in range(rng.randint(1, 8)):
            if segments and rng.random() < 0.4:
                segments.append(rng.choice(segments)[rng.randint(0, 5) :])
            else:
                segments.append(bytes(rng.choice(b"ab") if rng.random() < 0.9 else 99 for _ in range(rng.randint(0, rng.choice([30, 600])))))
        text = b"".join(segments)
        array = suffix_array.suffix_array(text, 64).tolist()
        cut = [text[k : k + 64] for k in array]
        assert sorted(array) == [*range(len(text))] and cut == sorted(cut)
        begin, met = suffix_array.repeated_windows(segments, width)
        seen = Counter(s[k : k + width] for s in segments for k in range(len(s) - width + 1))
        for s, at in zip(segments, begin.tolist(), strict=True):
            assert met[at : at + len(s)].tolist() == [k + width <= len(s) and seen[s[k : k + width]] > 1 for k in range(len(s))], turn


def brute_fingerprint(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    h = [xxhash.xxh64_intdigest(b" ".join(w[k : k + 4]), 42) for k in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components_of(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


@pytest.mark.parametrize("seed", range(30))
def test_gray_index(seed):
    rng, x = np.random.default_rng(seed), []
    for cur in rng.integers(0, 1 << 63, size=3, dtype=np.uint64):
        for _ in range(rng.integers(1, 80)):
            y = cur
            for _ in range(rng.integers(0, 4)):
                y = y ^ np.uint64(1) << np.uint64(rng.integers(0, 64))
            x.append(y)
            cur = y if rng.random() < 0.3 else cur
    x = np.unique(np.array(x, dtype=np.uint64))
    rng.shuffle(x)
    buckets = np.sort(rng.integers(0, 3, size=len(x)))
    links = [(i, j) for i in range(len(x)) for j in range(i) if buckets[i] == buckets[j] and np.bitwise_count(x[i] ^ x[j]) <= 4]
    want, found = components_of(len(x), links), simhash.bucket_components(x, buckets)
    assert len({*zip(want, found.tolist(), strict=True)}) == len({*want}) == len({*found.tolist()})


def test_simhash(spark, odd, none, monkeypatch):
    rng = random.Random(5)
    base = [" ".join(rng.choice("abcdefgh") * 3 for _ in range(120)) for _ in range(6)]
    rows = [(k, " ".join(w if rng.random() > 0.01 else "zz" for w in rng.choice(base).split())) for k in range(60)] + [(i, t) for i, t in ROWS if i is not None]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    fps = [brute_fingerprint(t) for _, t in rows]
    want = components_of(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4])
    least = {}
    for (i, _), c in zip(rows, want, strict=True):
        least[c] = min(least.get(c, i), i)
    expected = sorted(((i, f"{f:016x}", least[c]) for (i, _), f, c in zip(rows, fps, want, strict=True)), key=str)
    assert got(simhash.simhash_components(df), "doc_id", "fingerprint", "component_id") == expected
    monkeypatch.setattr(simhash, "LARGE", 2)
    assert got(simhash.simhash_components(df), "doc_id", "fingerprint", "component_id") == expected
    assert simhash.keep_one(odd).columns == odd.columns and simhash.simhash_components(none).count() == 0


def test_one_row_of_each_group_stays(spark):
    """Tables loaded twice, and groups of null ids only, keep one row of each group."""
    one, other = " ".join("abcdefghij" * 20), " ".join("klmnopqrst" * 20)
    rows = [(1, one), (1, one), (2, one), (2, one), (2, one.upper()), (None, other), (None, other), (None, other.upper()), (3, "alone"), (None, one)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit("x")).repartition(3)
    exact = exact_dedup.keep_first(df)
    assert exact.columns == df.columns
    assert sorted(((r.doc_id, lower(r.text)) for r in exact.collect()), key=str) == sorted([(2, one), (None, other), (3, "alone")], key=str)
    near = simhash.keep_one(df)
    assert near.columns == df.columns
    assert sorted(((r.doc_id, lower(r.text)) for r in near.collect()), key=str) == sorted([(1, one), (None, other), (3, "alone")], key=str)


def test_components(spark):
    links = [(k, k + 1) for k in range(0, 90)] + [(200, k) for k in range(201, 260)] + [(5, 5), (301, 300), (300, 301)]
    found = dict(got(components.connected_components(spark.createDataFrame(links, "a long, b long")), "node", "component"))
    assert found == {**{k: 0 for k in range(91)}, **{k: 200 for k in range(200, 260)}, 300: 300, 301: 300}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_decontamination(spark, odd, none, monkeypatch):
    rng = random.Random(2)
    text = lambda n: " ".join(f"w{rng.randint(0, 400)}" for _ in range(n))
    items = [(k, text(rng.randint(1, 60))) for k in range(40)] + [(90, None), (91, "!!")]
    docs = []
    for k in range(80):
        words = items[k % 40][1].split()
        cut = words[: max(1, int(len(words) * rng.uniform(0.6, 1)))]
        docs.append((k, f"{text(200)} {' '.join(cut).upper()}, {text(50)}"))

    def grams(t):
        w = re.findall(r"[^\x09-\x0D\x20-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(t))
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    want = sorted(((d, i, len(grams(t) & grams(x))) for d, t in docs for i, x in items if grams(x) and len(grams(t) & grams(x)) >= 0.8 * len(grams(x))), key=str)
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert want and got(decontamination.contained_items(df, bench), "doc_id", "item_id", "shared") == want
    both = [*docs, (None, docs[3][1]), (3, docs[3][1])]
    more = spark.createDataFrame(both, "doc_id long, text string")
    known = spark.createDataFrame([*items, (None, items[3][1]), items[4]], "item_id long, text string")
    small = got(decontamination.contained_items(more, known), "doc_id", "item_id", "shared", "size", "containment")
    assert len(small) > len(want) and any(r[1] is None for r in small)
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 500)  # the joined way
    assert got(decontamination.contained_items(df, bench), "doc_id", "item_id", "shared") == want
    assert got(decontamination.contained_items(more, known), "doc_id", "item_id", "shared", "size", "containment") == small
    assert decontamination.decontaminate(odd, bench).count() == len(ROWS)
    assert decontamination.contained_items(none, bench).count() == 0 == decontamination.contained_items(df, bench.limit(0)).count()


def test_decontamination_by_items_without_id(spark):
    item = "one two three four five six seven eight"
    docs = spark.createDataFrame([(1, f"so {item} and on"), (2, "nothing of it in these words here")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, item), (None, "other words that are nowhere at all")], "item_id long, text string")
    assert [r.doc_id for r in decontamination.decontaminate(docs, bench).collect()] == [2]


def test_language(spark, odd, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = language_id.identify_language(docs, language_id.fit_language_model(docs)).filter(language_id.remainder("doc_id", 4) == 2)
    assert out.filter("lang = lang_pred").count() / out.count() > 0.97
    model = language_id.fit_language_model(odd)
    assert {r.lang_pred for r in language_id.identify_language(odd, model).collect() if r.doc_id in (7, 9, 12)} == {"und"}
    assert {r.doc_id for r in language_id.keep_known(odd).collect()} == {5, 3, 11, 13, None}
    assert language_id.keep_known(odd).columns == odd.columns and language_id.keep_known(none).count() == 0
    a, b = Counter(), Counter()
    for counts, t in ((a, "abcab"), (b, "bcd")):
        counts.update({t[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)})
    m = language_id.Model(["abcab", "bcd"], ["x", "y"])
    assert abs(m.kernel(["abcab"])[0, 1] - len(a & b) / np.sqrt(len(a) * len(b))) < 1e-6


def brute_language(texts, langs, asked, landmarks):
    """Presence kernels, the Nyström map and one-versus-rest ridge regression, by plain linear algebra."""
    units = lambda t: [t.lower().encode("utf-16-le")[k : k + 2] for k in range(0, len(t.lower().encode("utf-16-le")), 2)]
    known = {c for t in texts for c in units(t)}

    def grams(t):
        t = [c if c in known else None for c in units(t)]
        return {tuple(t[i : i + n]) for n in (1, 2, 3) for i in range(len(t) - n + 1)}

    sets = {t: grams(t) for t in {*texts, *asked}}
    marks = [texts[k] for k in landmarks]
    kernel = lambda a, b: len(sets[a] & sets[b]) / np.sqrt(max(1, len(sets[a])) * max(1, len(sets[b])))
    k_mm = np.array([[kernel(a, b) for b in marks] for a in marks])
    k_nm = np.array([[kernel(a, b) for b in marks] for a in texts])
    values, vectors = np.linalg.eigh(k_mm)
    good = values > 1e-6 * values.max()
    root = vectors[:, good] @ np.diag(values[good] ** -0.5)
    names = sorted(set(langs))
    x = np.column_stack((k_nm @ root, np.ones(len(texts))))
    weight = np.diag([1 / (len(names) * langs.count(v)) for v in langs])
    out = []
    for name in names:
        y = np.array([1.0 if v == name else -1.0 for v in langs])
        out.append(np.linalg.solve(x.T @ weight @ x + language_id.RIDGE / len(names) / 10 * np.eye(x.shape[1]), x.T @ weight @ y))
    fit = np.array(out).T
    scores = np.column_stack((np.array([[kernel(a, b) for b in marks] for a in asked]) @ root, np.ones(len(asked)))) @ fit
    odds = np.exp(4 * scores)
    return [names[k] for k in scores.argmax(axis=1)], (odds / odds.sum(axis=1, keepdims=True)).max(axis=1)


@pytest.mark.parametrize("tabled", [0, 256])
def test_language_against_brute_force(monkeypatch, tabled):
    rng = random.Random(9)
    monkeypatch.setattr(language_id, "TABLED", tabled)
    monkeypatch.setattr(language_id, "LANDMARKS", 9)
    words = {"x": ["aba", "cab", "bad", "日本"], "y": ["ddo", "odd", "do", "é"], "z": ["rus", "sur", "urs", "𝒳a"]}
    text = lambda v, n: " ".join(rng.choice(words[v]) for _ in range(n)).title()
    langs = [v for v in "xyz" for _ in range(12)]
    texts = [text(v, rng.randint(2, 12)) for v in langs]
    asked = [text(rng.choice("xyz"), rng.randint(1, 6)) + rng.choice(["", " Ж", " rus", " bad"]) for _ in range(60)]
    model = language_id.Model(texts, langs)
    chosen = [k for v in "xyz" for k in [i for i, w in enumerate(langs) if w == v][:3]]
    want, odds = brute_language(texts, langs, asked, sorted(chosen))
    got_langs, scores, likeness = model.predict(asked)
    assert got_langs == want and np.abs(scores - odds).max() < 1e-3 and likeness.max() == 1 and likeness.min() < 1


def test_stage_goes_by_the_prediction(spark):
    rows = [(k, f"the cat {k} sat on the mat and the dog ran to the house", "en") for k in range(30)] + [(100 + k, f"der hund {k} lief zum haus und die katze schlief auf dem dach", "de") for k in range(30)]
    odd_ones = [(200, "Москва столица нашей страны", None), (201, "the mat", None), (202, "123", None), (203, None, "en")]
    df = spark.createDataFrame([*rows, *odd_ones], "doc_id long, text string, lang string")
    ids = lambda out: {r.doc_id for r in out.collect()}
    assert ids(language_id.keep_known(df)) == {*range(30), *range(100, 130), 201}
    assert ids(language_id.keep_known(df, languages=["en"])) == {*range(30), 201}
    assert 200 in ids(language_id.keep_known(df, least=0)) and ids(language_id.keep_known(df, languages=["xx"])) == set()


def test_names_that_clash_by_case_or_have_dots(spark):
    df = spark.createDataFrame([(1, "The cat", "en", "a", 5, 6, 7), (2, "the cat", "en", "b", 5, 6, 7)], "`doc.id` long, `a.text` string, lang string, `x.y` string, Kept int, LANG_PRED int, Group_Size int")
    one = exact_dedup.exact_dedup(df, "doc.id", "a.text")
    assert got(one, "`doc.id`", "keep_id", "group_size", "kept") == [(1, 2, 2, False), (2, 2, 2, True)] and "x.y" in one.columns
    model = language_id.fit_language_model(df, "doc.id", "a.text")
    assert {r.lang_pred for r in language_id.identify_language(df, model, "doc.id", "a.text").collect()} == {"en"}
    for keep in (exact_dedup.keep_first, simhash.keep_one):
        out = keep(df, "doc.id", "a.text")
        assert out.columns == df.columns and out.count() == 1
    assert language_id.keep_known(df, None, "doc.id", "a.text").columns == df.columns
    bench = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    assert decontamination.decontaminate(df, bench, "doc.id", "a.text").columns == df.columns
    assert bpe.bpe_encode(df, PATH, "doc.id", "a.text").count() == suffix_array.suffix_array_dedup(df, "doc.id", "a.text").count() == 2


def test_language_of_unlabelled_texts(spark):
    """Without a label und still means a null or letterless text, and only these go."""
    rows = [(1, "The cat sat", None), (2, None, None), (3, "123 !!", None), (None, "le chat", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit_language_model(df)
    assert got(language_id.identify_language(df, model), "doc_id", "lang_pred", "score") == sorted([(1, None, 0), (2, "und", 0), (3, "und", 0), (None, None, 0)], key=str)
    assert got(language_id.keep_known(df), "doc_id", "text") == sorted([(1, "The cat sat"), (None, "le chat")], key=str)


def test_every_language_is_learned(spark, monkeypatch):
    """Languages of long texts only, of null or repeated ids, and beyond the 64 most frequent."""
    long = [(k, f"{w} " * 3000, w) for k, w in enumerate(("alpha", "bravo") * 8)]
    df = spark.createDataFrame(long, "doc_id long, text string, lang string")
    out = language_id.identify_language(df, language_id.fit_language_model(df))
    assert out.filter("lang = lang_pred").count() == len(long)
    names = [f"{a}{b}" for a in "abcdefgh" for b in "ijklmnopq"]
    many = [(1000 * k + j, f"{w} " * 5, w) for k, w in enumerate(names) for j in range(8 if k < 64 else 4)]
    many += [(None, "zulu " * 5, "none")] + [(50000, "yankee " * 5, "a-again")] * 500
    df = spark.createDataFrame(many, "doc_id long, text string, lang string")
    for texts in (language_id.TEXTS, 10):
        monkeypatch.setattr(language_id, "TEXTS", texts)
        assert language_id.fit_language_model(df).langs == sorted({*names, "none", "a-again"})


def test_toxicity(spark, odd, none):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    net = toxicity.fit_toxicity(docs, labels)
    out = toxicity.score_toxicity(docs, net).join(labels, "doc_id").filter(toxicity.remainder("doc_id", 3) == 1).toPandas()
    hit, miss = out.score[out.toxic == 1].to_numpy(), out.score[out.toxic == 0].to_numpy()
    assert (hit[:, None] > miss[None]).mean() > 0.95 and (hit >= toxicity.THRESHOLD).mean() > 0.8 and (miss >= toxicity.THRESHOLD).mean() < 0.02
    scores = {r.doc_id: r.score for r in toxicity.score_toxicity(odd, net).collect()}
    assert scores[7] == scores[9] == 0 and 0 <= scores[11] <= 1
    assert toxicity.score_toxicity(none, net).count() == 0
    assert toxicity.train(["a"], [1]).blind and toxicity.Scorer(toxicity.train([], [])).scores(["x"]).tolist() == [0]


def test_toxicity_learns_of_long_texts_where_there_are_no_others(spark):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 3 != 1][:120]
    docs = spark.createDataFrame([(i, ("vile scum " if i % 2 else "kind word ") * (2000 if i % 2 else 20)) for i in ids] + [(ids[1], "vile scum " * 1999)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, toxic int")
    nets = [toxicity.fit_toxicity(docs.repartition(k), labels) for k in (1, 5)]
    assert not nets[0].blind and all((nets[0].p[k] == nets[1].p[k]).all() for k in nets[0].p)  # repeated ids, in whatever order


def brute_scores(net, text):
    """The score of a text, window by window and step by step, as the equations of the network say."""
    words = toxicity.words_of(text)
    if not words:
        return 0.0
    logistic = lambda v: 1 / (1 + np.exp(-v))
    p = {k: v.astype(np.float64) for k, v in net.p.items()}

    def inputs(w):
        bucket, grams, per = toxicity.features([w])
        return np.concatenate((p["words"][bucket[0]], p["chars"][grams].sum(axis=0) / np.sqrt(per[0]))) @ p["in"] + p["in0"]

    def read(xs, u):
        h, out, n = np.zeros(toxicity.HIDDEN), [], toxicity.HIDDEN
        for x in xs:
            z, r = logistic(x[:n] + h @ u[:, :n]), logistic(x[n : 2 * n] + h @ u[:, n : 2 * n])
            c = np.tanh(x[2 * n :] + (r * h) @ u[:, 2 * n :])
            h = (1 - z) * h + z * c
            out.append(h)
        return out

    best, start = -np.inf, 0
    while True:
        xs = [inputs(w) for w in words[start : start + toxicity.WINDOW]]
        pad = [np.zeros_like(xs[0])] * (toxicity.WINDOW - len(xs))
        half = 3 * toxicity.HIDDEN
        f = read([x[:half] for x in xs], p["f"])
        b = read([x[half:] for x in (xs + pad)[::-1]], p["b"])[::-1][: len(xs)]
        h = np.concatenate((f, b), axis=1)
        a = np.exp(h @ p["attend"])
        best = max(best, (a / a.sum()) @ h @ p["out"] + p["out0"][0])
        if start + toxicity.WINDOW >= len(words):
            return logistic(best)
        start = min(start + toxicity.STEP, len(words) - toxicity.WINDOW)


def test_toxicity_forward_and_windows(monkeypatch):
    """Every overlapping window of every length of text is scored, whatever is laid out together."""
    rng, net = random.Random(3), toxicity.Network()
    noise = np.random.default_rng(1)
    for v in net.p.values():
        v += noise.normal(0, 0.4, v.shape).astype(np.float32)
    texts = [" ".join(rng.choice(["fine", "Bad!", "scum", "x", "ünder", "to-day"]) for _ in range(n)) for n in (1, 5, 63, 64, 65, 96, 97, 128, 129, 500)] + ["", None]
    want = [brute_scores(net, t) for t in texts]
    assert np.abs(toxicity.Scorer(net).scores(texts) - want).max() < 1e-4
    monkeypatch.setattr(toxicity, "WINDOWS", 3)
    assert np.abs(toxicity.Scorer(net).scores(texts) - want).max() < 1e-4


def test_toxicity_gradient():
    """The written gradients of all parameters against differences."""
    net, rng = toxicity.Network(), np.random.default_rng(0)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    words = toxicity.features([b"one", b"two", b"three"])
    at, mask, y = rng.integers(0, 3, size=(6, 4)), np.ones((6, 4), dtype=bool), np.array([0.0, 1, 1, 0])
    mask[4:, 1] = False

    def loss():
        x = net.project(*words)[at]
        x[~mask] = 0
        z = net.forward(x, mask)[0].astype(np.float64)
        return float(np.mean(np.logaddexp(0, z) - y * z))

    found = {}
    net.adam = lambda name, where, grad: found.setdefault(name, (where, grad))
    net.learn(words, at, mask, y)
    assert sorted(found) == sorted(net.p)
    for name, (where, grad) in found.items():
        rows = np.arange(len(net.p[name])) if isinstance(where, slice) else where
        for _ in range(4):
            k = rng.integers(len(rows))
            inner = (rng.integers(grad.shape[1]),) if grad.ndim > 1 else ()
            place, old = (rows[k], *inner), net.p[name][(rows[k], *inner)]
            net.p[name][place] = old + 1e-2
            up = loss()
            net.p[name][place] = old - 1e-2
            down = loss()
            net.p[name][place] = old
            assert abs((up - down) / 2e-2 - grad[(k, *inner)]) < 2e-4, name


def test_warc(spark, monkeypatch):
    long = "x" * 120
    pages = [(5, "http://a/", long), (2, None, long), (9, "http://b/\r\nX: y", long), (3, "http://c/", "é"), (4, "u", "é"), (6, "u", None), (7, "u", "\r\n\r\nWARC/1.1\r\n" * 20)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    folder = new_folder(spark, "test")
    warc.write_warc(df, folder)
    out = {r.record_id: r for r in warc.assemble(warc.read_records(spark, folder)).collect()}
    assert len(out) == len(pages)
    for i, _, html in pages:
        r, body = out[f"<urn:capture:{i}:main>"], (html or "").encode()
        assert r.metadata.fields["payload-length"] == str(len(body)) and r.response.digest == hashlib.sha256(body).hexdigest()
        assert r.response.kind == ("revisit" if i in (5, 9) else "response") and r.request.request_id == f"<urn:capture:{i}:request>"
        assert r.response.refers_to == ("<urn:capture:2:main>" if i in (5, 9) else None)
        assert bytes(r.response.payload) == (b"" if i in (5, 9) else body)
    empty = new_folder(spark, "test")
    warc.write_warc(df.limit(0), empty)
    assert warc.assemble(warc.read_records(spark, empty)).count() == 0
    packed = zlib.compressobj(wbits=31)
    member = packed.compress(b"WARC/1.1\r\nWARC-Type: x\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n") + packed.flush()
    for piece in (1, 7, 1 << 20):
        monkeypatch.setattr(warc, "PIECE", piece)
        assert [b for _, b in warc.parse(warc.unzipped(member * 3))] == [b"abc"] * 3
    with pytest.raises(ValueError, match="isn't closed"):
        list(warc.parse([b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc\r\n\r\n"]))
    with pytest.raises(ValueError, match="no record at byte 0"):
        list(warc.parse([b"junk"]))


def test_warc_files_hold_few_pages_and_long_payloads(spark, monkeypatch):
    monkeypatch.setattr(warc, "PAGES", 3)
    pages = [(k, "u", f"page {k}") for k in range(20)] + [(20, "u", "x y " * 2_000_000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("tid", F.lit("own")).withColumn("first", F.lit(1)).coalesce(1)
    folder = new_folder(spark, "test")
    warc.write_warc(df, folder)
    assert spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).count() == 7
    out = warc.captured_pages(warc.read_records(spark, folder))
    assert got(out, "page_id", "payload_bytes") == sorted(((i, len(t)) for i, _, t in pages), key=str)
    wrong = warc.read_records(spark, folder).withColumn("bytes", F.col("bytes") + 1)
    with pytest.raises(Exception, match="another length"):
        warc.captured_pages(wrong).collect()


def test_warc_of_repeated_and_null_ids(spark):
    """Each row is one capture with its own payload, whatever its id; references name records that hold the payload."""
    a, b = "a" * 150, "b" * 150
    pages = [(5, "u", a), (5, "u", a), (5, "v", b), (2, "u", b), (2, "u", "short"), (9, "u", a), (9, "u", a), (None, "u", a), (None, "u", a), (None, None, None), (7, "u", "once")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    folder = new_folder(spark, "test")
    warc.write_warc(df, folder)
    records = warc.read_records(spark, folder).cache()
    first = {}
    for i, _, t in pages:
        if i is not None:
            first[t] = min(first.get(t, i), i)
    want = []
    for i, _, t in pages:
        body = (t or "").encode()
        again = i is not None and len(body) >= 100 and first[t] != i
        want.append((i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", first[t] if again else None))
    assert got(warc.captured_pages(records), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == sorted(want, key=str)
    out = {r.record_id: r for r in warc.assemble(records).collect()}
    assert records.count() == 3 * len(pages) == 3 * len(out) and "<urn:capture:7:main>" in out
    for r in out.values():
        if r.response.kind == "revisit":
            assert out[r.response.refers_to].response.kind == "response" and out[r.response.refers_to].response.digest == r.response.digest
        else:
            assert len(r.response.payload) == int(r.metadata.fields["payload-length"])
