"""The training-data operators against brute force, round trips and edge cases."""

import hashlib
import json
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lacuna.llm import chat, common, decontaminate, language, media, ngram_join, packing, pii, quality, repeats, suffix, toxicity
from lacuna.llm.common import words_of
from lacuna.llm.graph import components
from lacuna.llm.queries import vocabulary_path

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, set_id string, rank int"


@pytest.fixture(scope="module")
def rows():
    """Nulls, empty and long texts, repeated rows and ids, copies and columns that clash with inner names."""
    random.seed(5)
    word = lambda: "".join(random.choices("abcdeé", k=random.randint(2, 7)))
    base = " ".join(word() for _ in range(400))
    w = base.split()
    near = " ".join(w[:200] + ["zzz"] + w[201:])
    texts = [base, base, near, " ".join(word() for _ in range(300)) + " " + base[:900], None, "", "one two", "ab " * 3000, "#", base, "é" * 500, " ".join(word() for _ in range(20000)), "日本 語 x  y\n\n z"]
    out = [(i, t, "en" if i % 2 else "fr", "s0" if i % 3 else None, len(t or ""), "x", 1) for i, t in enumerate(texts)]
    return out + [(None, "null id text here now", None, None, None, None, None), (3, None, "en", "s1", 0, None, 2), (0, base, "fr", None, len(base), "x", 1)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def removed(texts, length):
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        m = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if count[d[i : i + length]] > 1:
                m[i : i + length] = True
        out.append((len(d), int(m.sum()), int((np.diff(np.concatenate([[0], m.astype(int)])) == 1).sum()), hashlib.sha256(bytes(np.frombuffer(d, np.uint8)[~m])).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("most", [1500, 0])
def test_repeats(docs, rows, most):
    got = repeats.digests(repeats.dedupe(docs, most=most)).collect()
    assert sorted(tuple(r)[1:5] for r in got) == removed([r[1] for r in rows], 400)
    assert all(len(r.text.encode()) >= r.n_bytes - r.n_removed and hashlib.sha256(r.text.encode()).hexdigest() == r.kept_sha256 for r in got if "\ufffd" not in r.text)


def test_repeats_in_small_shards(spark, docs, rows, none):
    got = repeats.digests(repeats.dedupe(docs, length=100, shard_bytes=1000)).collect()
    assert sorted(tuple(r)[1:5] for r in got) == removed([r[1] for r in rows], 100)
    assert repeats.dedupe(none).count() == 0


def test_suffix_array():
    random.seed(1)
    for _ in range(300):
        k = random.choice([1, 2, 3, 200])
        d = bytes(random.randrange(k) + (97 if k < 100 else 0) for _ in range(random.randint(0, 50)))
        assert suffix.suffix_array(d).tolist() == sorted(range(len(d)), key=lambda i: d[i:])


def test_suffix_array_by_depth():
    random.seed(2)
    texts = [bytes(random.randrange(97, 97 + k) for _ in range(n)) for k, n in ((1, 40), (2, 300), (5, 700))]
    for d in [*texts, texts[2] * 3, b"\xff".join(texts[1][:k] for k in range(50, 300, 20))]:
        for depth in (1, 5, 40):
            got = suffix.suffix_array(d, depth).tolist()
            assert sorted(got) == list(range(len(d)))
            assert [d[i : i + depth] for i in got] == sorted(d[i : i + depth] for i in range(len(d)))
            kinds = suffix.repeat_classes(d, depth).tolist()
            whole = range(len(d) - depth + 1)
            assert len({*zip(kinds, (d[i : i + depth] for i in whole))}) == len({d[i : i + depth] for i in whole}) == len({kinds[i] for i in whole})


def test_contexts_that_share_the_same_are_sorted_once():
    random.seed(3)
    text = bytes(random.randrange(97, 123) for _ in range(700))
    near = [text[:20] + b"1" + text[21:600] + c + text[601:] for c in (b"2", b"3")] + [text[:600] + b"4" + text[601:]]
    # the first two differ from each other at 600, from the third one at 20 too; no byte more is left of any
    cut = repeats.trimmed(near, [300] * 3, 400)
    assert cut == [(300, near[0][:600])] * 2 + [(279, text[21:600])]
    first, _, third = repeats.repeated_windows([(1, cut[0][1], 300, 2), (1, near[1][:610], 300, 1), (1, cut[2][1], 279, 1)], 400)
    assert first.tolist() == list(range(201)) and third.tolist() == list(range(180))
    assert [len(x) for x in repeats.repeated_windows([(1, cut[0][1], 300, 1), (2, cut[0][1], 300, 1)], 400)] == [0, 0]


@pytest.mark.parametrize("quantum", [1, 128])
def test_packing(docs, rows, quantum, none):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary_path())
    out = packing.pack(docs, vocabulary_path(), quantum=quantum).collect()
    want = Counter()
    for r in rows:
        ids = t.encode(r[1] or "", add_special_tokens=False).ids + [1]
        want[(r[0], len(ids))] += 1
    assert sum(r.length for r in out) == sum(n * c for (_, n), c in want.items())
    windows = defaultdict(list)
    for r in out:
        windows[r.sequence_id].append((r.offset, r.length))
    for k, v in windows.items():
        at = 0
        for a, n in sorted(v):
            assert a == at
            at += n
        assert at == 2048 or k == max(windows)
    lone = [i for i, c in Counter(r[0] for r in rows).items() if c == 1 and i is not None]
    by = defaultdict(list)
    for r in out:
        by[r.doc_id].append(r)
    for i in lone:
        text = next(r[1] for r in rows if r[0] == i)
        ids, at = np.array(t.encode(text or "", add_special_tokens=False).ids + [1], "<u4"), 0
        for r in sorted(by[i], key=lambda r: r.start):
            assert r.start == at and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes()) and r.doc_tokens == len(ids)
            at += r.length
        assert at == len(ids)
    assert packing.pack(none, vocabulary_path()).count() == 0


def test_packing_mixture():
    totals = np.array([6000, 3000, 1000])
    got = [packing.pieces(np.array([n]), np.array([0]), np.array([q]), totals, 16, 512) for q, n in enumerate(totals)]
    ranks = np.concatenate([np.concatenate([np.arange(k, k + n) for k, n in zip(g[3], g[2])]) for g in got])
    assert (np.sort(ranks) == np.arange(10000)).all()
    for w in range(19):
        share = [sum(n for k, n in zip(g[3], g[2]) if k // 512 == w) for g in got]
        assert abs(share[0] - 307.2) <= 32 and abs(share[1] - 153.6) <= 32 and abs(share[2] - 51.2) <= 32


def test_media(docs, rows, none, spark):
    out = media.media_columns(docs).collect()
    assert all((r.width, r.height, r.depth) == (576, r.payload_bytes // 576, 8) for r in out)
    got = sorted(((r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in out))
    want = []
    for r in rows:
        raw = (r[1] or "").encode()
        p = raw + b"\xff" * (-len(raw) % 576 or (0 if raw else 576))
        want.append((len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:])))
    assert got == sorted(want)
    assert media.media_columns(none).count() == 0
    from lacuna.llm.common import shared_path, written

    folder = shared_path(spark, "media")
    heads = media.headers(written(media.store(docs, folder), "index"), folder).collect()
    assert all(r.width == 576 and r.depth == 8 and r.height * 576 >= max(1, r.n_bytes) for r in heads)


def test_quality(spark, docs, none):
    ids = spark.createDataFrame([(0,), (3,), (None,), (999,)], "doc_id long")
    got = quality.classify(docs, ids).collect()
    assert len(got) == docs.count() and not any(r.kept for r in got if r.perplexity is None)
    assert quality.classify(none, ids).count() == 0
    assert quality.classify(docs, ids.where("doc_id < 0")).where("kept").count() == docs.where("length(text) > 0").count()


@pytest.mark.parametrize("folds", [True, False])
def test_quality_brute_force(spark, folds, monkeypatch):
    """Perplexities of the interpolated modified Kneser-Ney model by its definition, on counts in dictionaries; with frequent words and chunks as small as in no table."""
    random.seed(8)
    monkeypatch.setattr(quality, "FREQUENT", 5)
    words = ["the", "of", "Cat", "dog", "sat", "é", "x1", "run", "b", "c", "d"]
    text = lambda n: " ".join(random.choices(words, range(len(words), 0, -1), k=n))
    data = [(i, text(random.randint(1, 60)), "en") for i in range(40)] + [(41, text(9) + " rare", None), (42, "never seen", "de"), (50, "", "en"), (51, None, None), (52, "?!", "en"), (None, "the cat", "en"), (3, text(5), "en"), (60, text(3000), "en")]
    if folds:
        data.append((4, next(t for i, t, _ in data if i == 5), "en"))
    else:
        data = [(i, t, lang) for i, t, lang in data if i is None or i >= 20 or quality.fold_of(t) == 0]
    ids = set(range(20))
    trusted = [t for i, t, _ in data if i in ids and t]

    def model(texts):
        pairs = Counter(p for t in texts for p in zip([b"<"] + words_of(t), words_of(t)))
        ends = Counter(w for _, w in pairs)
        cuts = []
        for c in (pairs, ends):
            m = Counter(c.values())
            y = m[1] / (m[1] + 2 * m[2]) if m[1] else 0
            raw = [1 - 2 * y * m[2] / m[1], 2 - 3 * y * m[3] / m[2], 3 - 4 * y * m[4] / m[3] if m[3] else 0.5] if m[1] and m[2] else [0.5] * 3
            cuts.append([min(max(d, 0.05), k + 0.95) if m[1] and m[2] else d for k, d in enumerate(raw)])
        cut = lambda k, order: cuts[order][min(k, 3) - 1] if k else 0
        rest = sum(cut(k, 1) for k in ends.values()) / len(pairs) / (len(ends) + 1)
        one = lambda w: (ends[w] - cut(ends[w], 1)) / len(pairs) + rest

        def prob(h, w):
            after = [k for (a, _), k in pairs.items() if a == h]
            if not after:
                return one(w)
            k = pairs[h, w]
            return (k - cut(k, 0) + sum(cut(x, 0) for x in after) * one(w)) / sum(after)

        known = list(ends)
        assert all(abs(sum(prob(h, w) for w in known) + prob(h, None) - 1) < 1e-9 for h in known[:4] + [b"<", b"new"])
        return prob

    parts = [[t for t in trusted if quality.fold_of(t) == f] for f in (1, 0)]
    models = [model(p if all(parts) else trusted) for p in parts]

    def perplexity(t):
        w = words_of(t)
        return float(np.exp(-np.mean([np.log(models[quality.fold_of(t)](*p)) for p in zip([b"<"] + w, w)]))) if w else None

    df = spark.createDataFrame(data, "doc_id long, text string, lang string").repartition(3)
    df = quality.written(df, "docs")
    rows = quality.classify(df, spark.createDataFrame([(i,) for i in ids], "doc_id long"), quantile=0.8).collect()
    # rows of one id are told apart by their perplexities
    key = lambda r: (r[0] is None, r[0] or 0, r[2] or 0)
    got = sorted([(r.doc_id, r.lang, r.perplexity) for r in rows], key=key)
    want = sorted([(i, lang, perplexity(t)) for i, t, lang in data], key=key)
    assert len(got) == len(want) and bool(all(parts)) == folds
    for g, w in zip(got, want):
        assert g[:2] == w[:2] and (g[2] == w[2] if w[2] is None else abs(g[2] - w[2]) < 1e-3 * w[2]), (g, w)
    good = sorted(p for i, _, p in want if i in ids and p)
    limit = good[int(np.ceil(0.8 * len(good))) - 1]
    assert all(r.kept == (r.perplexity is not None and r.perplexity <= limit * (1 + 1e-6)) for r in rows)


def test_quality_rows_are_short():
    rng = np.random.default_rng(4)
    arrays = [np.sort(rng.choice([5, 1 << 16, (1 << 16) - 1, 1 << 45], 1000)), np.zeros(0, np.uint64), rng.integers(0, 9, 13), rng.random(7).astype(np.float32), np.array([1 << 40])]
    assert all(a.tolist() == b.tolist() for a, b in zip(arrays, quality.unsqueeze(quality.squeeze(*arrays)), strict=True))
    # of 20,000 numbers half are of two bytes and half of six, and a bit each says which
    codes = np.where(rng.random(20_000) < 0.5, rng.integers(0, 1 << 16, 20_000), rng.integers(1 << 44, 1 << 45, 20_000))
    assert len(quality.squeeze(codes)) < 10_000 * (2 + 6) + 20_000 // 8 + 500
    # weights repeat
    assert len(quality.squeeze(np.repeat(rng.random(1000).astype(np.float32), 3))) < 1000 * 4 + 1000
    size = 500
    a, b, unit = rng.integers(0, size, 30_000), rng.integers(0, size, 30_000), rng.integers(0, 90, 30_000)
    codes = np.unique(rng.integers(1, 1 << 45, 2 * size).astype(np.uint64))[:size]
    got = Counter()
    for shard, data in quality.by_shard(a, b, unit, codes, 90, 7):
        x, y, pair, u, n = quality.entries(data)
        assert (quality.shards_of(x, 7) == shard).all()
        got.update(dict(zip(zip(x[pair].tolist(), y[pair].tolist(), u.tolist()), n.tolist())))
    assert got == Counter(zip(codes[a].tolist(), codes[b].tolist(), unit.tolist()))


def test_quality_chunks(monkeypatch):
    """Pairs come back from their packed form, and chunks hold every word once whatever their size."""
    import pandas as pd

    texts = ["a b c a b", None, "", "b a " * 40, "c"] * 3
    monkeypatch.setattr(quality, "CHUNK_WORDS", 30)
    found = Counter()
    for rows, numbers, sizes, codes in quality.chunks([pd.DataFrame({"text": texts})], np.zeros(0, np.int64)):
        assert len(rows) == len(sizes) and sizes.sum() == len(numbers)
        at = np.repeat(np.arange(len(rows)), sizes)
        for shard, data in quality.by_shard(quality.before(numbers, sizes), numbers, at, codes, len(rows), 4):
            a, b, pair, unit, n = quality.entries(data)
            assert (quality.shards_of(a, 4) == shard).all()
            for p, u, k in zip(pair, unit, n):
                found[int(a[p]), int(b[p])] += int(k)
    code = lambda w: quality.hashed(w) | 1 << quality.BITS
    words = [[code(w) for w in t.encode().split()] for t in texts if t]
    assert found == Counter(p for w in words for p in zip([quality.EDGE] + w, w))


def test_pii_brute_force(spark):
    """The Feistel network written again, and run backwards: it is the same permutation, and each value comes back."""
    key = pii.subkey("k")

    def turn(sign, left, right, a, b, tweak):
        digest = lambda i, x: int(hashlib.sha256(f"{key}|{tweak}|{i}|{x}".encode()).hexdigest()[:15], 16)
        for i in range(8) if sign > 0 else range(7, -1, -1):
            if i % 2 == 0:
                left = (left + sign * (digest(i, right) % a)) % a
            else:
                right = (right + sign * (digest(i, left) % b)) % b
        return left, right

    def permuted(d, kind, sign):
        u, n = len(d) // 2, len(d)
        x, y = turn(sign, int(d[:u] or 0), int(d[u:]), 10**u, 10 ** (n - u), f"{kind}{n}")
        return (str(x).zfill(u) if u else "") + str(y).zfill(n - u)

    luhn = lambda s: str(-sum(d if i % 2 else d * 2 - 9 * (d > 4) for i, d in enumerate(int(c) for c in reversed(s))) % 10)
    random.seed(6)
    bodies = ["".join(random.choices("0123456789", k=15)) for _ in range(30)]
    cards = [b + luhn(b) for b in bodies]
    got = [r.text for r in pii.pseudonymise(spark.createDataFrame([*enumerate(cards)], "doc_id int, text string"), "k").orderBy("doc_id").collect()]
    assert got == [(n := permuted(b, "card", 1)) + luhn(n) for b in bodies]
    assert [permuted(g[:-1], "card", -1) for g in got] == bodies
    addresses = [".".join(str(random.randrange(256)) for _ in range(4)) for _ in range(30)]
    got = [r.text for r in pii.pseudonymise(spark.createDataFrame([*enumerate(addresses)], "doc_id int, text string"), "k").orderBy("doc_id").collect()]
    for old, new in zip(addresses, got):
        a, b, c, d = map(int, new.split("."))
        x, y = turn(-1, a * 256 + b, c * 256 + d, 65536, 65536, "ip")
        assert f"{x >> 8}.{x & 255}.{y >> 8}.{y & 255}" == old


def test_toxicity_risk_stays_positive():
    """With a prior that is too high the plain risk of the negative part falls below zero; the correction holds it near zero."""
    rng = np.random.default_rng(4)
    rows = lambda n, toxic: [np.sort(np.unique(np.concatenate([rng.integers(0, 300, 12), [500 + int(rng.integers(20))] if toxic else []]).astype(np.int32))) for _ in range(n)]
    positive, unlabelled = rows(400, True), rows(300, True) + rows(300, False)
    prior = 0.9
    chosen, w, b = toxicity.fit(positive, unlabelled, prior, least_z=2.0)
    logit = lambda data: np.array([w[np.searchsorted(chosen, r[np.isin(r, chosen)])].sum() + b for r in data])
    negative = lambda u, p: float(np.logaddexp(0, u).mean() - prior * np.logaddexp(0, p).mean())
    assert negative(logit(unlabelled), logit(positive)) > -0.1
    x = lambda data: np.array([np.isin(chosen, r) for r in data], float)
    xp, xu, v, c = x(positive), x(unlabelled), np.zeros(len(chosen)), 0.0
    sigmoid = lambda s: 1 / (1 + np.exp(-s))
    for _ in range(2000):  # the plain risk, by gradient descent
        sp, su = xp @ v + c, xu @ v + c
        gp, gu = -prior * np.ones(len(sp)) / len(sp), sigmoid(su) / len(su)
        v, c = v - 0.5 * (xp.T @ gp + xu.T @ gu), c - 0.5 * (gp.sum() + gu.sum())
    assert negative(xu @ v + c, xp @ v + c) < -0.1


def test_toxicity_repeats(spark):
    """A run can be repeated where more rows are eligible than are taken, whatever the partitions."""
    random.seed(2)
    data = [(i % 700, " ".join(random.choices("abcdefgh", k=8) + (["vile"] if i % 700 % 4 == 0 else []))) for i in range(2100)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(700)], "doc_id long, toxic int")
    a, b = (Counter((r.doc_id, round(r.score, 9)) for r in toxicity.classify(df.repartition(n), labels, F.col("doc_id") % 5 == 0, most_rows=60).collect()) for n in (2, 7))
    assert a == b


def test_packing_of_other_vocabularies(tmp_path):
    """A file with another pre-split gets whole texts."""
    made = json.load(open(vocabulary_path()))
    made["pre_tokenizer"]["add_prefix_space"] = True
    (tmp_path / "v.json").write_text(json.dumps(made))
    from tokenizers import Tokenizer

    texts = ["a few words, 12 of them's", " lead", "é x\n\n y", ""]
    e, t = packing.Encoder(str(tmp_path / "v.json")), Tokenizer.from_file(str(tmp_path / "v.json"))
    assert not e.known_split and packing.Encoder(vocabulary_path()).known_split
    assert [np.frombuffer(x, "<u2").tolist() for x in e.batch(texts)] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_packing_splits_whole_batches():
    rng, e = random.Random(7), packing.Encoder(vocabulary_path())
    some = [*map(chr, range(256)), *["'", " ", "s", "e", "l", "r", "\n", "1", "."] * 20, "'ll", "'re", "''s", "\n's", " 's"]
    for _ in range(300):
        texts = ["".join(rng.choices(some, k=rng.randint(0, 40))) for _ in range(4)]
        parts = [t.encode("latin-1") for t in texts]
        data = b"\n".join([*parts, b""])
        kind = packing.KINDS[np.frombuffer(data, np.uint8)]
        kind[np.cumsum([len(x) + 1 for x in parts]) - 1] = packing.END
        begin = packing.word_starts(np.frombuffer(data, np.uint8), kind)
        words = [data[a:b].decode("latin-1") for a, b in zip(begin, [*begin[1:], len(data)]) if kind[a] != packing.END]
        assert words == [w for t in texts for w in packing.LATIN_SPLIT.findall(t)]
        assert e.batch(texts) == e.whole(texts)


def test_packing_encodes_runs_of_words(monkeypatch):
    rng, e = random.Random(5), packing.Encoder(vocabulary_path(), keep=300)
    texts = ["".join(rng.choice(["", " ", "  ", "\n"]) + "".join(rng.choices("aeinrst\xe9\xdf", k=rng.randint(1, 9))) + rng.choice(["", ".", "'s", "12", " '"]) for _ in range(200)) for _ in range(20)] + ["", " ", "<|endoftext|>", "\u65e5\u672c"]
    calls, whole = [], e.whole
    monkeypatch.setattr(e, "whole", lambda x: calls.extend(x) or whole(x))
    for part in (texts[:8], texts[4:], texts):  # words move on between generations
        assert e.batch(part) == whole(part)
    words = {w for t in texts for w in packing.LATIN_SPLIT.findall(t)}
    assert len({w for w in words if w[0] == " "}) > 500 and not {w for w in words if w[0] == " " and w[1:].isalpha()} & {*calls}


def test_language(spark, docs, none):
    en, de = "the man and the woman are in the house with other people ", "der mann und die frau sind nicht in einem haus mit anderen "
    data = [(i, (en if i % 2 else de) * 3, "en" if i % 2 else "de", f"s{i % 2}") for i in range(40)] + [(90, de, "en", "s1"), (91, "12 34 ##", "en", "s1"), (92, None, None, None)]
    got = {r.doc_id: r for r in language.identify_documents(spark.createDataFrame(data, "doc_id long, text string, lang string, source string"), temper=0.5).collect()}
    assert all(got[i].language == ("en" if i % 2 else "de") and got[i].language_kept for i in range(40))
    assert got[90].language == "de" and not got[91].language_kept and not got[92].language_kept
    assert language.identify_documents(docs).count() == docs.count() and language.identify_documents(none).count() == 0
    pages = language.identify_pages(spark.read.parquet(f"{SF}/pages.parquet")).withColumn("declared", language.markup_language(F.col("html")))
    assert pages.where("language = declared").count() > 0.9 * pages.count()


def test_pii(spark, docs, none):
    texts = ["+1 (974) 555-3436 x 4111 1111 1111 1111", "4111111111111111 on 2023-02-28", "2023-02-31 300.1.1.1", 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"', "10.0.0.1 a.b@c.org 01/02/2020", None, ""]
    got = [r.text for r in pii.pseudonymise(spark.createDataFrame([*enumerate(texts)], "doc_id int, text string"), "k").orderBy("doc_id").collect()]
    digits = lambda s: "".join(c for c in s if c.isdigit())
    a, b = got[0].split(" x ")[1], got[1].split(" on ")[0]
    assert digits(a) == b and b != "4111111111111111" and sum(d if i % 2 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, b))) % 10 == 0
    assert got[0].startswith("+1 (") and "974" not in got[0][:9] and got[2] == texts[2] and got[5] is None and got[6] == ""
    assert len(got[3]) == len(texts[3]) and got[3] != texts[3] and "a.b@c.org" not in got[4] and "10.0.0.1" not in got[4]
    n = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("d")).select(pii.digits_permuted(F.col("d"), "k", "t").alias("d")).distinct()
    assert n.count() == 1000
    days = spark.range(3000).select(F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("d")).select(pii.date(F.col("d"), "k").alias("d"))
    assert days.distinct().count() == 3000
    out = pii.pseudonymise(docs, "k")
    assert out.columns == [*docs.columns, "pii_count", "pii_kinds"] and out.count() == docs.count() and pii.pseudonymise(none, "k").count() == 0


def test_pii_validated_numbers(spark):
    """Cards pass Luhn and IBANs mod 97 before and after; numbers that fail stay and don't count."""
    luhn = lambda s: sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(int(c) for c in reversed(s) if c.isdigit())) % 10 == 0
    mod97 = lambda s: int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1
    stay = ["9780306406157", "1700000000001", "4111 1111 1111 1112", "DE88370400440532013000", "GB30 1234 5678 9012 3456", "XX12 0000 0000 0000"]
    assert not any(luhn(s) for s in stay[:3]) and not any(mod97(s.replace(" ", "")) for s in stay[3:])
    cards, ibans = ["4111111111111111", "4111 1111 1111 1111", "5500-0000-0000-0004", "6011000990139424001"[:16]], ["DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "BE68 5390 0754 7034", "PL61109010140000071219812874"]
    assert all(map(luhn, cards)) and all(mod97(s.replace(" ", "")) for s in ibans)
    texts = [f"a {s} b" for s in stay + cards + ibans]
    got = pii.pseudonymise(spark.createDataFrame([*enumerate(texts)], "doc_id int, text string"), "k").orderBy("doc_id").collect()
    for s, r in zip(stay + cards + ibans, got):
        new = r.text[2:-2]
        if s in stay:
            assert new == s and r.pii_count == 0, s
        else:
            assert new != s and r.pii_count == 1 and [c.isdigit() for c in new] == [c.isdigit() for c in s], s
            assert luhn(new) if s in cards else mod97(new.replace(" ", "")) and new[:2] == s[:2], s
    flat = lambda r: r.text.replace(" ", "")
    assert flat(got[6]) == flat(got[7]) and flat(got[10]) == flat(got[11])


def test_clashing_names(spark):
    """Columns named like results are replaced by them, in operators 5 and 6; the pipeline's stages give them back as they were."""
    data = [(i, "the man and the woman are at a.b@c.org in the house", "en", "s", "mine", 7) for i in range(4)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, language string, pii_count int")
    assert {r.language for r in language.identify_documents(docs).collect()} == {"en"}
    assert {r.pii_count for r in pii.pseudonymise(docs, "k").collect()} == {1}
    for stage in (corpus_pipeline.identify_language, corpus_pipeline.pseudonymise):
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and {(r.language, r.pii_count) for r in out.collect()} == {("mine", 7)}


def test_key_is_not_in_plans(spark):
    docs = spark.createDataFrame([(1, "4111111111111111")], "doc_id long, text string")
    plan = pii.pseudonymise(docs, "very secret key")._jdf.queryExecution().toString()
    assert "very secret key" not in plan
    one, two = (pii.pseudonymise(docs, k).first().text for k in ("k", "l"))
    assert one != two


def test_shared_folder():
    """Without spark.checkpoint.dir a folder of one machine serves only what runs on it."""
    from types import SimpleNamespace

    from lacuna.llm import common

    def session(master, folder=None):
        conf = {"spark.sql.execution.arrow.maxRecordsPerBatch": "500", "spark.checkpoint.dir": folder}
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf[k]), sparkContext=SimpleNamespace(master=master))

    assert common.shared_root(session("yarn", "hdfs://a/b/")) == "hdfs://a/b"
    assert common.shared_root(session("local[4]")).startswith("file://")
    for master in ("yarn", "spark://somewhere:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            common.shared_root(session(master))


def grams(text):
    w = words_of(text)
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


@pytest.mark.parametrize("block", [256, 2])
def test_ngram_join(spark, block):
    random.seed(3)
    data, base = [], [[f"w{random.randrange(900)}" for _ in range(120)] for _ in range(6)]
    for k, w in enumerate(base):
        for c in range(6):
            v = list(w)
            for _ in range(c):
                v[random.randrange(len(v))] = f"n{random.randrange(10**6)}"
            data.append((k * 10 + c, " ".join(v)))
    data += [(100, data[0][1].upper()), (101, None), (102, ""), (103, "a b"), (104, "a, b!"), (105, "...")]
    got = {r.doc_id: r for r in ngram_join.classify(spark.createDataFrame(data, "doc_id long, text string"), block=block).collect()}
    sets = {i: grams(t) for i, t in data}
    kinds = {s for s in sets.values() if s}
    near = lambda a, b: a != b and len(a & b) >= 0.8 * len(a | b)
    for i, s in sets.items():
        assert got[i].n_links == sum(near(s, o) for o in kinds if s), i
        group, more = {s}, True
        while more and s:
            new = {o for o in kinds for g in group if near(g, o)} - group
            group, more = group | new, bool(new)
        assert got[i].class_id == (min(j for j, o in sets.items() if o in group) if s else i)


def test_ngram_join_edges(docs, none):
    got = ngram_join.classify(docs).collect()
    assert len(got) == docs.count() and {r.class_id for r in got if r.doc_id in (0, 1, 2, 9)} == {0}
    assert ngram_join.classify(none).count() == 0


def test_batches_of_large_rows(spark):
    import pandas as pd

    common.small_batches(spark)

    def sizes(batches):
        for pdf in batches:
            yield pd.DataFrame({"n": [int(pdf["data"].map(len).sum())]})

    rows = spark.range(40, numPartitions=1).select(F.expr("cast(repeat('x', 1000000) as binary)").alias("data"))
    found = [r["n"] for r in rows.mapInPandas(sizes, "n long").collect()]
    assert sum(found) == 40_000_000 and max(found) <= (8 << 20) + 1_000_000


def test_tidied(monkeypatch):
    seen = []
    monkeypatch.setattr(common, "tidy", lambda name=None: seen.append("tidy"))
    task = common.tidied(lambda batches: (seen.append(x) or x for x in batches))
    assert [*task([1, 2])] == [1, 2] and seen == ["tidy", 1, 2, "tidy"]


def test_written_tables_go(spark):
    import os

    from lacuna.llm import common

    a, b = (common.written(spark.range(5), "t") for _ in range(2))
    folder = lambda t: t.written_to.removeprefix("file:").replace("//", "/")
    common.discard(a)
    assert not os.path.exists(folder(a)) and b.count() == 5
    common.discard_all(spark)
    assert not os.path.exists(folder(b)) and not common.WRITTEN
    common.discard(spark.range(3))


def test_components(spark):
    e = [(i, i + 1) for i in range(0, 40) if i % 10 != 9] + [(99, 50), (50, 60), (60, 60), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(e, "u long, v long")).collect()}
    assert all(got[i] == i // 10 * 10 for i in range(40)) and got[99] == got[60] == 50


def brute_hits(text, items, window=10):
    w, hit, names = words_of(text), set(), set()
    for name, t in items:
        x = words_of(t)
        n = min(window, len(x))
        spans = {tuple(x[i : i + n]) for i in range(len(x) - n + 1)} if x else set()
        for i in range(len(w) - n + 1 if n else 0):
            if tuple(w[i : i + n]) in spans:
                hit |= {*range(i, i + n)}
                names.add(name)
    return len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("block", [200_000, 30])
def test_decontaminate(spark, docs, rows, none, block):
    random.seed(9)
    text = lambda n: " ".join(random.choices("abcd", k=n))
    items = [(i, text(random.choice([3, 9, 10, 14, 25]))) for i in range(25)] + [(30, None), (31, "!"), (32, "b c d a a"), (33, "c d a a"), (34, "c d a a")]
    data = [(i, text(random.randint(0, 120))) for i in range(60)] + [(99, None), (100, "é B, c; D a-A")]
    it = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in decontaminate.report(spark.createDataFrame(data, "doc_id long, text string"), it, block_words=block).collect()}
    names = [(str(i), t) for i, t in items]
    assert got == {i: brute_hits(t, names) for i, t in data}
    left = decontaminate.clean(spark.createDataFrame(data, "doc_id long, text string"), it, most_coverage=1.0, block_words=block).collect()
    assert all(brute_hits(r.text, names)[1] == 0 for r in left)
    assert decontaminate.clean(docs, it).columns == docs.columns and decontaminate.report(none, it).count() == 0
    assert decontaminate.report(docs, it.where("item_id < 0")).where("contaminated").count() == 0


def test_toxicity(spark, docs, none):
    random.seed(2)
    word = lambda: "".join(random.choices("abcdefgh", k=3))
    data = [(i, " ".join([word() for _ in range(30)] + (["vile", "nasty"] if i % 4 == 0 else []))) for i in range(2000)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(0, 2000) if i % 3 == 0] + [(None, 1)], "doc_id long, toxic int")
    got = toxicity.classify(df, labels, F.col("doc_id") % 5 == 0).collect()
    assert sum(r.predicted == int(r.doc_id % 4 == 0) for r in got if r.held_out) > 0.95 * sum(r.held_out for r in got)
    assert toxicity.classify(docs, labels, F.col("doc_id") % 5 == 0).count() == docs.count() and toxicity.classify(none, labels, F.lit(False)).count() == 0


def test_chat(spark):
    texts = ["", None, " lead", "é日 <|im_end|>", "<\\|im_sep|><|", "a\n\n", "<|im_end|><|im_start|>assistant ok", "<|endoftext|>"]
    data = [(c, t, random.Random(c * 9 + t).choice(["user", "assistant", "system", None]), random.Random(c + t * 7).choice(texts)) for c in range(30) for t in range(6)]
    data += [(None, 0, "assistant", "x"), (5, 2, "assistant", "tie"), (5, 2, "assistant", "tie")]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: tuple(r)[1:5] for r in chat.digests(chat.format_conversations(df, vocabulary_path())).collect()}
    by = defaultdict(list)
    for c, t, r, x in data:
        by[c].append((t, r or "", x or ""))
    for c, turns in by.items():
        turns.sort()
        under = "".join(x for _, r, x in turns if r == "assistant")
        assert got[c] == (len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest(), len(under), hashlib.sha256(under.encode()).hexdigest())
    assert all(chat.unescaped(chat.escaped(s)) == s for s in map(str, filter(None, texts)))
    assert chat.format_conversations(df.limit(0), vocabulary_path()).count() == 0


def test_pipeline(spark, docs, tmp_path):
    spark.createDataFrame([(1, "x")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    d = docs.drop("set_id", "rank")
    for name, f in corpus_pipeline.STAGES[:-1]:
        out = f(spark, d, str(tmp_path))
        assert out.columns == d.columns, name
        out.write.parquet(f"{tmp_path}/{name}")
        d = spark.read.parquet(f"{tmp_path}/{name}")
    pieces = corpus_pipeline.STAGES[-1][1](spark, d, str(tmp_path))
    assert pieces.count() > 0 and json.dumps(sorted(pieces.columns))
    assert d.where("doc_id in (1, 2, 9)").count() == 0 and d.where("doc_id = 11").count() == 1


def test_near_duplicates_by_text(spark):
    """Different texts under one id all stay, one row of each group stays, and null ids are no exception."""
    random.seed(11)
    text = lambda: " ".join(f"w{random.randrange(10**6)}" for _ in range(80))
    a, b, c, d, e, f = (text() for _ in range(6))
    near = c.rsplit(" ", 1)[0] + " changed"
    data = [(1, a, "p"), (1, b, "q"), (2, a, "r"), (2, d, "s"), (3, d.upper(), "t"), (3, d.upper(), "u"), (None, c, "v"), (None, near, "w"), (None, c, "x"), (None, e, "y"), (9, e, "z"), (None, f, "a"), (8, f, "b"), (8, f, "c"), (7, "", "d"), (6, "", "e"), (6, "", "f"), (5, None, "g"), (5, "", "h"), (5, "#", "i")]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string").repartition(3)
    got = Counter((r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect())
    one = {(None, t) for t in (c, near)} & got.keys()
    assert len(one) == 1
    assert got == Counter([(1, a), (1, b), (2, d), *one, (9, e), (8, f), (7, ""), (6, ""), (5, None), (5, ""), (5, "#")])


def test_language_brute_force(spark):
    """Posteriors by the formulas in the module's docstring, with plain loops and dictionaries."""
    from lacuna.llm.charcodes import CLASSES, TABLE

    random.seed(12)
    letters = {"aa": "abcdef", "bb": "defghi", "cc": "ghijéü"}
    word = lambda k: "".join(random.choices(letters[k], k=random.randint(2, 6)))
    data = []
    for i in range(60):
        k = random.choice(["aa", "aa", "bb", "cc"])
        said = random.choice([k, k, k.upper() + "-XX", None, random.choice(["aa", "bb", "cc"])])
        data.append((i, " ".join(word(k) for _ in range(random.randint(1, 12))), said, random.choice(["site1", "site2", "other7", "a.b.org", None])))
    data += [(90, "12 34 ##", "aa", "site1"), (91, None, "bb", "site2"), (92, "", None, None)]
    classes = lambda t: [0, 0] + [int(TABLE[b]) for b in (t or "").encode()]
    tag = lambda x: x.lower().split("-")[0] if x else None
    domain = lambda h: (".".join(h.split(".")[-2:]) if "." in h else h.rstrip("0123456789")) if h else ""
    names = sorted({tag(x) for _, _, x, _ in data} - {None})
    tri = {k: Counter() for k in names}
    for _, t, x, _ in data:
        c = classes(t)
        if tag(x):
            tri[tag(x)].update(tuple(c[j : j + 3]) for j in range(len(c) - 2))
    ends = {k: (Counter(), Counter(), Counter()) for k in names}
    for k in names:
        for g, n in tri[k].items():
            for part, at in zip(ends[k], (g[2:], g[1:], g[1:2])):
                part[at] += n
    firsts = {k: Counter() for k in names}
    for k in names:
        for g, n in tri[k].items():
            firsts[k][g[:2]] += n

    def loglik(k, t):
        c, total = classes(t), 0.0
        one_n, two_n, mid_n = ends[k]
        every = sum(tri[k].values())
        for j in range(len(c) - 2):
            g = tuple(c[j : j + 3])
            one = (one_n[g[2:]] + 0.5) / (every + 0.5 * CLASSES)
            two = (two_n[g[1:]] + 8 * one) / (mid_n[g[1:2]] + 8)
            total += np.log((tri[k][g] + 8 * two) / (firsts[k][g[:2]] + 8))
        return total

    has = lambda t: any(1 <= x <= 26 or x >= 31 for x in classes(t)[2:])
    best = {i: max(names, key=lambda k: loglik(k, t)) for i, t, _, _ in data if has(t)}
    by = {w: defaultdict(Counter) for w in ("host", "domain", "said")}
    for i, _, x, h in data:
        if i in best:
            by["host"][h or ""][best[i]] += 1
            by["domain"][domain(h)][best[i]] += 1
            if tag(x):
                by["said"][tag(x)][best[i]] += 1
    whole = {k: 1 + sum(b == k for b in best.values()) for k in names}
    whole = {k: v / sum(whole.values()) for k, v in whole.items()}
    smooth = lambda n, prior, k: (n[k] + 20 * prior) / (sum(n.values()) + 20)
    got = {r.doc_id: r for r in language.identify_documents(spark.createDataFrame(data, "doc_id long, text string, lang string, source string").repartition(3)).collect()}
    for i, t, x, h in data:
        if not has(t):
            assert got[i].language is None and not got[i].language_kept
            continue
        total = {}
        for k in names:
            prior = smooth(by["host"][h or ""], smooth(by["domain"][domain(h)], whole[k], k), k)
            total[k] = 0.1 * loglik(k, t) + np.log(prior)
            if tag(x):
                total[k] += np.log((by["said"][tag(x)][k] + 0.5 / len(names)) / (0.5 + sum(c[k] for c in by["said"].values())))
        top = max(names, key=total.get)
        p = 1 / sum(np.exp(v - total[top]) for v in total.values())
        assert got[i].language == top and abs(got[i].language_posterior - p) < 1e-4
        assert got[i].language_kept == (p >= 0.5 and loglik(top, t) / len(t.encode()) >= -np.log(CLASSES))


def test_every_declared_language(spark):
    """150 languages of their own letters each get their own; blocks and tags don't change that."""
    random.seed(4)
    sets = [random.sample("abcdefghijklmnopqrstuvwxyz", 5) for _ in range(150)]
    word = lambda k: "".join(random.choices(sets[k], k=6))
    data = [(k * 3 + i, " ".join(word(k) for _ in range(150)), [f"l{k:03d}", f"L{k:03d}-xx", f"l{k:03d}_YY"][i], f"h{k}") for k in range(150) for i in range(3)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string").repartition(3)
    got = {r.doc_id: r for r in language.identify_documents(df).collect()}
    assert {i: got[i].language for i, *_ in data} == {i: f"l{i // 3:03d}" for i, *_ in data}
    few = df.where("doc_id < 30")
    one, more = ({r.doc_id: r for r in language.identify_documents(few, block=b, temper=0.001).collect()} for b in (64, 3))
    assert {r.language for r in one.values()} == {f"l{k:03d}" for k in range(10)}
    assert all(one[i].language == more[i].language and one[i].language_kept == more[i].language_kept and abs(one[i].language_posterior - more[i].language_posterior) < 1e-9 for i in one)


def test_packing_targets(spark):
    """Windows follow the weights until a queue runs dry, then the weights of the rest; every source has a queue of its own."""
    totals, rates = np.array([6000, 3000, 1000]), np.array([1.0, 1.0, 2.0])
    got = [packing.pieces(np.array([n]), np.array([0]), np.array([q]), totals, 16, 500, rates) for q, n in enumerate(totals)]
    at = [np.concatenate([np.arange(k, k + n) for k, n in zip(g[3], g[2])]) for g in got]
    assert (np.sort(np.concatenate(at)) == np.arange(10000)).all()
    share = lambda lo, hi: [int(((a >= lo) & (a < hi)).sum()) for a in at]
    near = lambda got, want: all(abs(g - w) <= 32 for g, w in zip(got, want))
    assert all(near(share(lo, lo + 500), (125, 125, 250)) for lo in range(0, 2000, 500))
    assert near(share(2200, 4200), (1000, 1000, 0)) and near(share(8000, 10000), (2000, 0, 0))
    df = spark.createDataFrame([(i, "a few words here " * 20, f"s{i}") for i in range(1100)], "doc_id long, text string, source string").repartition(3)
    out = packing.pack(df, vocabulary_path(), weights={f"s{i}": 1 + i % 2 for i in range(1100)}).collect()
    assert {(r.doc_id, r.queue) for r in out} == {(i, f"=s{i}") for i in range(1100)}
    assert sum(r.length for r in out) == sum({r.doc_id: r.doc_tokens for r in out}.values())
    with pytest.raises(ValueError):
        packing.pack(df, vocabulary_path(), weights={"s0": 1})
