"""Every corpus operator against a plain version, and on odd rows."""

import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gridloom.llm import ann, common, components, embdedup, langid, licenses, mixing, packing, simhash, tokenbin, tokencount, urlfilter, wordcodec

DOCS = "doc_id long, text string, lang string, component_id string, rate int, id long"
WORDS = "stone river light house garden window summer winter letter number market bridge forest island castle silver".split()
rng = random.Random(5)


def text(n, r=rng):
    return " ".join(r.choice(WORDS) + r.choice(["", "s", "ed", "ing"]) for _ in range(n))


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, "x", 1, 9) for i, t, lang in rows], DOCS)


LONG = text(3000)
BASE = text(120)
ROWS = [(k, text(rng.randint(1, 60)), ["en", "de", None][k % 3]) for k in range(40)]
ROWS += [(50, None, None), (51, "", "en"), (52, "   \n", None), (53, LONG, "en"), (54, LONG, "de"), (55, BASE, "en"), (56, BASE + " end", "en"), (57, "One", None), (58, "Été ĞŘ 日本語 😀", None)]
ROWS += [(55, BASE, "en"), (None, BASE, None), (None, None, None), (60, "!!! 123", "en"), (61, "<|endoftext|> a\tb  c", "en")]


def roots(pairs, nodes):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def plain_fingerprint(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("block", [1024, 2])
def test_simhash_links_are_exact(spark, block):
    values = [rng.getrandbits(64) for _ in range(20)]
    for v in list(values):
        for flips in (1, 2, 3, 4):
            for b in rng.sample(range(64), flips):
                v ^= 1 << b
            values.append(v)
    values = sorted(set(values))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    found = simhash.links(spark.createDataFrame([(s,) for s in signed], "fp long"), block).collect()
    pairs = [(a, b) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) & (2**64 - 1)).bit_count() <= 3]
    assert roots([(r.a, r.b) for r in found], signed) == roots(pairs, signed)


def test_simhash_documents(spark):
    got = simhash.near_duplicates(docs(spark, ROWS)).collect()
    assert Counter((r.doc_id, r.fingerprint) for r in got) == Counter((i, f"{plain_fingerprint(t):016x}") for i, t, _ in ROWS)
    prints = sorted({plain_fingerprint(t) for _, t, _ in ROWS})
    of = roots([(a, b) for a in prints for b in prints if a != b and (a ^ b).bit_count() <= 3], prints)
    least = defaultdict(lambda: math.inf)
    for i, t, _ in ROWS:
        if i is not None:
            least[of[plain_fingerprint(t)]] = min(least[of[plain_fingerprint(t)]], i)
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == {i: least[of[plain_fingerprint(t)]] for i, t, _ in ROWS if i is not None}
    kept = simhash.keep_one(docs(spark, ROWS))
    assert kept.columns == docs(spark, []).columns
    assert sorted(r.doc_id for r in kept.where("doc_id IS NOT NULL").collect()) == sorted(set(least.values()))


def test_keep_one_of_repeated_ids_and_clashing_names(spark):
    rows = [(1, text(50), 0, "a"), (1, text(50), 1, "b"), (2, BASE, 2, "c"), (2, BASE, 3, "d"), (3, BASE, 4, "e"), (None, BASE, 5, "f"), (4, text(40), 6, "g")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, kept_id int, turn string").selectExpr("*", "0 AS print", "1 AS __n")
    got = simhash.keep_one(frame)
    assert got.columns == frame.columns
    kept = Counter((r.doc_id, r.text) for r in got.collect())
    assert kept == Counter([(1, rows[0][1]), (1, rows[1][1]), (2, BASE), (None, BASE), (4, rows[6][1])])


def plans_of(monkeypatch, module):
    """Plans of all tables that ``module`` writes from now on."""
    plans = []
    monkeypatch.setattr(module, "written", lambda df, name: (plans.append(df._jdf.queryExecution().executedPlan().toString()), common.written(df, name))[1])
    return plans


def test_links_broadcast_no_replicas(spark, monkeypatch):
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "10485760b"
    plans, rounds = plans_of(monkeypatch, simhash), plans_of(monkeypatch, components)
    simhash._grouped(spark.createDataFrame([(k, k) for k in range(40)], "id long, fp long"), simhash.BLOCK)
    assert sum("SortMergeJoin" in p for p in plans) >= 4 and sum("SortMergeJoin" in p for p in rounds) >= 2
    assert not any("BroadcastHashJoin" in p for p in plans + rounds)


def test_fingerprints_of_documents_are_joined_without_broadcast(spark):
    plan = simhash.near_duplicates(docs(spark, ROWS))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_components_of_a_hub(spark):
    rows = [(0, k) for k in range(1, 3000)] + [(5000 + k, 5001 + k) for k in range(40)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert got == roots(rows, {x for p in rows for x in p})


def test_components(spark):
    pairs = [(k, k + 1) for k in range(30)] + [(100 + rng.randrange(20), 100 + rng.randrange(20)) for _ in range(12)]
    rows = [*pairs, (5, 5), (None, 3), (1, 0)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(rows, "a long, b long")).collect()}
    nodes = {x for p in pairs if p[0] != p[1] for x in p}
    assert got == roots([p for p in pairs if p[0] != p[1]], nodes)
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_word_codec_is_exact():
    chars = "abzA Zé'  \n\t!?.0 1²½\x85\xa0€Œœß'stredvml''-_—“”|\x00\x1c\x1f\x7fµªñÑÿŸİΣ日\u0301▁"
    texts = ["".join(rng.choice(chars) for _ in range(rng.randint(0, 30))) for _ in range(4000)] + [t or "" for _, t, _ in ROWS] + ["a <|endoftext|>b", "<s> x</s><unk>"]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        path = public_tokenizers.path(name)
        encode, library = wordcodec.encoder(path), Tokenizer.from_file(path)
        assert [encode(t) for t in texts] == [wordcodec.id_bytes(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    count, model = wordcodec.counter(path), sentencepiece.SentencePieceProcessor(model_file=path)
    assert [count(t) for t in texts] == [len(model.encode(t)) for t in texts]


def test_stream_coding_round_trip():
    for n in (0, 1, 3, 4, 5, 1000):
        ranks = np.array([rng.choice([0, 255, 256, 65535, 65536, 2**24, 2**32 - 1]) for _ in range(n)], "<u4")
        assert (tokenbin.unpack(*tokenbin.pack(ranks), n) == ranks).all()


def test_token_shards(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    where = tokenbin.new_path(spark, "test")
    tokenbin.write(docs(spark, ROWS), where, path, 0, shard_ids=2000, block_ids=500)
    got = tokenbin.read_digests(spark, where).collect()
    library = Tokenizer.from_file(path)
    want = [(i, np.array(library.encode(t or "", add_special_tokens=False).ids + [0], "<u4").tobytes()) for i, t, _ in ROWS]
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((i, len(b) // 4, zlib.crc32(b)) for i, b in want)
    ordered = sorted(got, key=lambda r: r.start)
    ids = [-1 if r.doc_id is None else r.doc_id for r in ordered]
    assert ids == sorted(ids) and [r.start for r in ordered] == np.cumsum([0] + [r.n_tokens for r in ordered])[:-1].tolist()
    ranks = {r["rank"]: r["id"] for r in spark.read.parquet(f"{where}/ranks").collect()}
    counts = Counter(x for _, b in want for x in np.frombuffer(b, "<u4").tolist())
    assert [ranks[k] for k in range(len(ranks))] == sorted(counts, key=lambda x: (-counts[x], x))
    assert tokenbin.round_trip(docs(spark, []), path).count() == 0


def test_letters_of_texts_in_parts(monkeypatch):
    r = random.Random(3)
    some = ["".join(r.choice("aÉß  .1\nΣb") for _ in range(r.randrange(40))) for _ in range(3000)]
    whole = [langid.letters(t) for t in some]
    monkeypatch.setattr(langid, "CHUNK", 7)
    assert [langid.letters(t) for t in some] == whole


def test_slices_hold_every_row_in_order(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(common, "SLICE", 10)
    for texts in ([], [None], ["", None, ""], ["a" * 50, "b", None, "c" * 9, "dd", "e" * 25, ""]):
        batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["id", "t"])
        parts = list(common.slices(batch, 1))
        assert [t for p in parts for t in p.column(1).to_pylist()] == texts
        assert all(p.num_rows and sum(len(t or "") for t in p.column(1).to_pylist()[1:]) <= 10 for p in parts)


def test_store_of_words_stays_in_its_room():
    made = []
    store = wordcodec._Store(lambda part: made.append(part) or part.encode(), 20_000)
    r = random.Random(8)
    for k in range(20_000):
        part = "the" if k % 3 == 0 else str(r.randrange(5000))
        assert store[part] == part.encode()
        assert len(store) * wordcodec.ENTRY <= 20_000
    assert made.count("the") == 1
    assert store["x" * 20_000] == b"x" * 20_000 and "x" * 20_000 not in store


def test_language_id(spark):
    alphabet = {"aa": "abcde", "bb": "fghij", "cc": "klmno"}
    rows = [(k, " ".join("".join(rng.choice(alphabet[lang]) for _ in range(5)) for _ in range(20)), lang) for k in range(300) for lang in [("aa", "bb", "cc")[k % 3]]]
    odd = [(400, None, "aa"), (401, "12 !", None), (402, "", "bb"), (None, "abcde abc", None), (403, "fghij " * 200_000, None), (5, rows[5][1], None)]
    got = langid.identify(docs(spark, rows + odd))
    held = {r.doc_id: r.held_out for r in got.collect()}
    assert all(held[i] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _, _ in rows) and held[None] is False
    found = {r.doc_id: r for r in got.collect()}
    assert all(found[i].lang_pred == lang for i, _, lang in rows if held[i])
    assert [found[i].lang_pred for i in (400, 401, 402, 403, None)] == ["und", "und", "und", "bb", "aa"]
    assert all(0 <= r.score <= 1 for r in found.values()) and got.count() == len(rows) + len(odd)
    kept = langid.keep_identified(docs(spark, rows + odd))
    assert kept.count() == len(rows) + 3 and kept.columns == docs(spark, []).columns
    assert langid.identify(docs(spark, [])).count() == 0 and {r.lang_pred for r in langid.identify(docs(spark, [(1, "abc", None)])).collect()} == {"und"}


def plain_grams(t):
    """Every n-gram of one to three characters, hashed with whole numbers."""
    for n in (1, 2, 3):
        for i in range(len(t) - n + 1):
            mixed = 0
            for c in t[i : i + n]:
                mixed = (mixed * 0x01000193 + ord(c) * 0x9E3779B1) % 2**32
            h = mixed ^ (mixed >> 15) ^ (n * 0x51ED)
            yield (h * 0x85EBCA6B) % 2**32 >> (32 - 15)


def plain_letters(t):
    words = "".join(c if c.isalpha() or (c.isalnum() and not c.isdigit() and re.match(r"[^\W\d_]", c)) else " " for c in t or "").lower().split()
    return f" {' '.join(words)} " if words else ""


def test_language_id_matches_plain_naive_bayes(spark, monkeypatch):
    monkeypatch.setattr(langid, "CHUNK", 97)  # texts are scored in many parts
    rows = [(k, text(rng.randint(1, 30)) if k % 2 else "".join(rng.choice("éàçñ öüß ab") for _ in range(rng.randint(1, 200))), ["fr", "en"][k % 2]) for k in range(60)] + [(70, "", "en"), (71, "123", "fr")]
    counts = {lang: Counter() for lang in ("en", "fr")}
    for i, t, lang in rows:
        if zlib.crc32(str(i).encode()) % 4 != 2:
            counts[lang].update(plain_grams(plain_letters(t)))
    log = {lang: (lambda b, c=c, n=sum(c.values()): math.log((c[b] + 0.5) / (n + 0.5 * 2**15))) for lang, c in counts.items()}
    langs, weights = langid.train(docs(spark, rows).where(~langid.held_out()))
    found, sure = langid.scores([t for _, t, _ in rows], langs, weights)
    for (_, t, _), lang, score in zip(rows, found, sure, strict=True):
        grams = list(plain_grams(plain_letters(t)))
        if not grams:
            assert (lang, score) == ("und", 0.0)
            continue
        total = {k: min(1, langid.EVIDENCE / len(grams)) * sum(map(log[k], grams)) for k in langs}
        odds = {k: math.exp(v - max(total.values())) for k, v in total.items()}
        best = max(langs, key=total.get)
        assert lang == best and abs(score - odds[best] / sum(odds.values())) < 1e-4


def test_token_counts_and_cache(spark, monkeypatch):
    path = public_tokenizers.path("piece_bpe_32k.model")
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    cache = tokencount.new_path(spark, "cache")
    got = tokencount.token_counts(docs(spark, ROWS), path, cache, limit=50).collect()
    want = Counter((i, len((t or "").encode()), len(model.encode(t or "")), len(model.encode(t or "")) > 50) for i, t, _ in ROWS)
    assert Counter(tuple(r) for r in got) == want
    stored = spark.read.parquet(cache)
    assert stored.count() == stored.distinct().count() == len({t or "" for _, t, _ in ROWS})
    tokencount.token_counts(docs(spark, [*ROWS, (70, "brand new", None)]), path, cache).collect()
    assert spark.read.parquet(cache).count() == len({t or "" for _, t, _ in ROWS}) + 1
    assert tokencount.token_counts(docs(spark, []), path).count() == 0


def test_mixing_meets_targets(spark):
    topics = {"clean": "stone river garden", "poor": "BUY NOW CHEAP", "toxic": "idiot clown fool"}
    rows = [(k, " ".join(rng.choice(topics[d].split() + ["the", "of"]) for _ in range(rng.randint(5, 60))), None) for k in range(300) for d in [("clean", "clean", "poor", "toxic")[k % 4]]]
    labels = spark.createDataFrame([(k, int(k % 4 != 2), int(k % 4 == 3)) for k in range(0, 300, 2)] + [(k, int(k % 4 != 2), int(k % 4 == 3)) for k in range(3, 300, 8)] + [(3, 1, 1), (None, 1, 1), (9, None, None)], "doc_id long, quality int, toxic int")
    frame = docs(spark, [*rows, (900, None, None), (901, "", None), (None, "stone", None), (5, rows[5][1], None)])
    mixed = mixing.mix(frame, mixing.domains(labels)).collect()
    assert len(mixed) == len(rows) + 4 and all(r.rate >= 0 for r in mixed)
    total = sum(r.n_tokens for r in mixed)
    for d, share in mixing.TARGETS.items():
        assert abs(sum(r.rate * r.n_tokens * r[f"p_{d}"] for r in mixed) / total - share) < 1e-4
    domain = {r.doc_id: r.domain for r in mixed}
    assert sum(domain[k] == ("clean", "clean", "poor", "toxic")[k % 4] for k in range(300)) > 280
    again = mixing.resample(frame, mixing.mix(frame, mixing.domains(labels)))
    assert again.columns == frame.columns
    rate, times = {r.doc_id: r.rate for r in mixed}, Counter(r.doc_id for r in again.collect())
    assert all(math.floor(rate[k]) <= times[k] <= math.floor(rate[k]) + 1 for k in rate if k not in (None, 5))
    assert mixing.mix(docs(spark, []), mixing.domains(labels)).count() == 0
    assert {r.rate for r in mixing.mix(frame, mixing.domains(labels.limit(0))).collect()} == {1.0}


def test_mixing_matches_plain_projection(spark):
    r = np.random.default_rng(2)
    p, n = r.dirichlet([0.3, 0.3, 0.3], 200), r.integers(1, 50, 200)
    frame = spark.createDataFrame([(k, k, int(n[k]), *map(float, p[k])) for k in range(200)], "doc_id long, uid long, n_tokens long, p0 double, p1 double, p2 double")
    got = np.array([x.rate for x in mixing.rates(frame, ["a", "b", "c"], {"a": 5, "b": 1}).orderBy("doc_id").collect()])
    rate, metric, goal = np.ones(200), np.linalg.inv((p * n[:, None]).T @ p), n.sum() * np.array([5, 1, 0]) / 6
    for _ in range(mixing.STEPS):
        rate = np.maximum(0, rate - p @ (metric @ ((rate * n) @ p - goal)))
    assert np.abs(got - rate).max() < 1e-5


@pytest.mark.parametrize("labelled", [[(1, "clean"), (2, "clean")], [(90, "clean"), (91, "toxic")], [(51, "clean"), (50, "toxic")]])
def test_mixing_with_labels_that_tell_nothing(spark, labelled):
    found = mixing.mix(docs(spark, ROWS), spark.createDataFrame(labelled, "doc_id long, domain string"), keep=["clean"]).collect()
    assert len(found) == len(ROWS) and {round(x.rate, 6) for x in found} == {1.0} and {x.domain for x in found} == {"clean"}


@pytest.mark.parametrize("share", [0.97, 0.5])
def test_mixing_keeps_a_domain_whole(spark, share):
    r = np.random.default_rng(3)
    p = np.where(r.random(300)[:, None] < share, r.dirichlet([30, 1], 300), r.dirichlet([1, 30], 300))
    n = r.integers(1, 50, 300)
    frame = spark.createDataFrame([(k, k, int(n[k]), *map(float, p[k])) for k in range(300)], "doc_id long, uid long, n_tokens long, p0 double, p1 double")
    rate = np.array([x.rate for x in mixing.rates(frame, ["good", "other"], {"good": 0.9, "other": 0.1}, keep=["good"]).orderBy("doc_id").collect()])
    assert (rate[p[:, 0] >= p[:, 1]] >= 1).all() and (rate >= 0).all()
    total = n @ (rate[:, None] * p) / n.sum()
    if share < 0.9:
        assert np.abs(total - [0.9, 0.1]).max() < 1e-3
    else:
        assert total[0] >= n @ p[:, 0] / n.sum() - 0.02  # out of reach: good documents are not cut down


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", 3) for i, v in rows], "vec_id long, embedding array<double>, cls string, v int")


def vector_rows():
    r = np.random.default_rng(1)
    rows = [list(map(float, r.normal(size=8))) for _ in range(60)]
    rows += [[x + 0.03 * float(r.normal()) for x in rows[k % 5]] for k in range(60)] + [rows[0]] * 5 + [[2 * x for x in rows[1]]]
    bad = [None, [], [0.0] * 8, [float("nan")] + [1.0] * 7, [float("inf")] + [1.0] * 7, [None] + [1.0] * 7]
    return [*enumerate(rows), *((500 + k, v) for k, v in enumerate(bad)), (None, rows[2])]


@pytest.mark.parametrize(("cell", "block"), [(4096, 4096), (8, 4)])
def test_embedding_dedup_is_exact(spark, cell, block):
    rows = vector_rows()
    got = {r.vec_id: r for r in embdedup.near_duplicates(vectors(spark, rows), cell=cell, block=block).collect()}
    fine = [(i, np.array(v) / np.linalg.norm(v)) for i, v in rows if i is not None and i < 500]
    pairs = [(a, b) for a, x in fine for b, y in fine if a != b and x @ y >= 0.95]
    of, n = roots(pairs, [i for i, _ in fine]), Counter(a for a, _ in pairs)
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (n[i], of[i], of[i] == i) for i, _ in fine)
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i in range(500, 506)) and got[None].n_links == 0
    assert embdedup.near_duplicates(vectors(spark, [])).count() == 0


def test_embedding_dedup_writes_each_vector_once(spark, monkeypatch):
    r = np.random.default_rng(8)
    rows = [(k, list(map(float, r.normal(size=64)))) for k in range(1500)]  # evenly spread: nearly every block meets every other
    counts = {}

    def counted(df, name):
        found = common.written(df, name)
        counts[name] = found.count()
        return found

    monkeypatch.setattr(embdedup, "written", counted)
    got = embdedup.near_duplicates(vectors(spark, rows + [(5000 + k, rows[k][1]) for k in range(300)]), cell=100, block=100).collect()
    assert sum(r.n_links for r in got) == 600 and max(counts.values()) <= 1800, counts


def test_neighbours(spark):
    r = np.random.default_rng(4)
    rows = [(k, list(map(float, r.normal(size=16) * r.uniform(0.5, 2)))) for k in range(900)]
    rows += [(900, rows[7][1]), (920, rows[7][1]), (940, None), (960, [0.0] * 16), (7, rows[7][1])]
    frame = vectors(spark, rows)
    got = defaultdict(dict)
    for x in ann.search(ann.index(frame, shard=300), frame.where("vec_id % 20 = 0"), k=10, beam=60).collect():
        got[x.query_id][x["rank"]] = (x.vec_id, x.score)
    plain = {i: np.array(v) for i, v in rows if v is not None and any(v)}
    hits = 0
    for q in got:
        best = sorted(((-float(v @ plain[q]), i) for i, v in plain.items() if i != q))[:10]
        hits += len({i for _, i in best} & {i for i, _ in got[q].values()})
        assert all(abs(s - plain[i] @ plain[q]) < 1e-9 for i, s in got[q].values())
        assert [got[q][k + 1][0] for k in range(10)] == [i for i, _ in sorted(got[q].values(), key=lambda x: (-x[1], x[0]))]
    assert set(got) == {i for i in plain if i % 20 == 0} and hits >= 0.9 * 10 * len(got)
    few = ann.search(ann.index(vectors(spark, rows[:5])), vectors(spark, rows[:1]), k=10).collect()
    assert len(few) == 4 and ann.search(ann.index(vectors(spark, [])), frame).count() == 0


def test_neighbours_of_extreme_norms_and_mixed_lengths(spark):
    r = np.random.default_rng(9)
    plain = {k: r.normal(size=16) for k in range(200)}
    plain |= {200: plain[3] * 1e25, 201: plain[4] * 1e-30, 202: np.full(16, 1e200), 203: plain[5] * 1e4, 220: plain[6] * 1e25}
    short = {k: r.normal(size=3) for k in range(300, 330)}
    frame = vectors(spark, [(i, list(map(float, v))) for i, v in (plain | short).items()])
    got = defaultdict(dict)
    for x in ann.search(ann.index(frame), frame.where("vec_id % 20 = 0"), k=10).collect():
        got[x.query_id][x["rank"]] = (x.vec_id, x.score)
    assert set(got) == {k for k in plain if k % 20 == 0} | {300, 320}
    for q, found in got.items():
        some = plain if q in plain else short
        with np.errstate(over="ignore"):
            best = sorted(((-float(v @ some[q]), i) for i, v in some.items() if i != q))[:10]
        assert [found[k + 1][0] for k in range(10)] == [i for _, i in best]


def test_walks_meet_few_points(spark):
    r = np.random.default_rng(12)
    centres = r.normal(size=(60, 24))
    points = (centres[r.integers(0, 60, 4000)] + 0.6 * r.normal(size=(4000, 24))).astype(np.float32)
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    queries = points[::40]
    met, _, seen = ann.beam_search(points, *ann.build(points), queries, 48, 48)
    best = np.argsort(-(queries @ points.T), 1)[:, :20]
    recall = np.mean([len(set(a) & set(b)) / 20 for a, b in zip(met.tolist(), best.tolist())])
    assert recall >= 0.9 and seen.mean() < 0.3 * len(points)


def test_embedding_dedup_of_mixed_lengths(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.01]), (3, [1.0, 0.0, 0.0]), (4, [1.0, 0.0, 0.01]), (5, [1.0, 0.01, 0.0]), (6, [3.0]), (7, [2.0]), (8, [-2.0])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embdedup.near_duplicates(vectors(spark, rows)).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (2, 3), 4: (2, 3), 5: (2, 3), 6: (1, 6), 7: (1, 6), 8: (0, 8)}


def test_sites_domains_and_suffixes(spark):
    names = {"a.bbc.co.uk": ("a.bbc.co.uk", "bbc.co.uk", "co.uk"), "h.com:8080": ("h.com", "h.com", "com"), "u@x.h.com": ("x.h.com", "h.com", "com"), "10.0.0.1:80": ("10.0.0.1", "10.0.0.1", "(address)"), "[::1]:80": ("[::1]", "[::1]", "(address)"), "localhost": ("localhost", "localhost", "localhost"), "co.uk": ("co.uk", "co.uk", "co.uk"), "x.github.io": ("x.github.io", "x.github.io", "github.io")}
    frame = spark.createDataFrame([(h,) for h in names], "host string").withColumn("site", urlfilter.site(F.col("host")))
    got = {r[0]: tuple(r)[1:] for r in frame.select("host", "site", urlfilter.domain(F.col("site")), urlfilter.suffix(F.col("site"))).collect()}
    assert got == names


def test_neighbours_of_a_common_vector(spark):
    r = np.random.default_rng(6)
    plain = {i: r.normal(size=12) for i in range(400)}
    for i in range(0, 400, 3):
        plain[i] = plain[0]
    rows = [(i, list(map(float, v))) for i, v in plain.items()]
    frame = vectors(spark, [*rows, rows[3], (3, rows[5][1]), (399, rows[1][1])])
    asked = frame.where("vec_id % 20 = 0")
    got = defaultdict(list)
    for x in ann.search(ann.index(frame, shard=60), asked, k=15, beam=80).orderBy("query_id", "rank").collect():
        got[x.query_id].append(x.vec_id)
    pairs = [(i, plain[i]) for i in plain] + [(3, plain[5]), (399, plain[1])]
    for q in range(0, 400, 20):
        best = sorted((-round(float(v @ plain[q]), 9), i) for i, v in pairs if i != q)[:15]
        assert got[q] == [i for _, i in best]


def test_url_filter(spark):
    urls = ["http://A.Example.com/de/1?x", "https://x.example.net/en/2", "http://q.net", "http://q.net/", "x://b.org/fr/#a", "nothing", None, "", "http://", "https://notexample.com/de/", "ftp://example.com/de", "a://b://c/d"]
    urls += [f"http://spam{k % 2}.bad.com/{k}" for k in range(60)] + [f"http://site{k % 5}.good.com/{k}" for k in range(60)] + ["http://new.bad.com/", "http://new.good.com/"]
    pages = spark.createDataFrame([(k, u, 1, "y") for k, u in enumerate(urls)], "page_id long, url string, host int, verdict string")
    outcomes = spark.createDataFrame([(k, int("bad.com" in (u or ""))) for k, u in enumerate(urls) if u and ("spam" in u or "site" in u)] + [(0, None), (None, 1)], "page_id long, bad int")
    got = {r.page_id: r for r in urlfilter.judge(pages, outcomes).collect()}
    assert [(got[k].host, got[k].path) for k in range(12)] == [("a.example.com", "/de/1"), ("x.example.net", "/en/2"), ("q.net", ""), ("q.net", "/"), ("b.org", "/fr/"), ("", ""), ("", ""), ("", ""), ("", ""), ("notexample.com", "/de/"), ("example.com", "/de"), ("b:", "//c/d")]
    assert [got[k].rule for k in range(12)] == ["example.com/de/", "example.net/en/", None, "net/", "org/fr/", *[None] * 7]
    assert [got[k].verdict for k in range(5)] == ["block", "allow", "allow", "block", "allow"]
    assert all(got[k].verdict == ("block" if "bad.com" in u else "allow") for k, u in enumerate(urls) if k >= 12)
    assert urlfilter.judge(pages, outcomes.limit(0)).count() == len(urls) and urlfilter.judge(pages.limit(0), outcomes).count() == 0


def test_license_rules(spark):
    assert len(licenses.rules()) > 300
    texts = ["Licensed under the MIT License.", "cc by cc-by, CC BY!", "the GNU General\nPublic License and All rights reserved. all rights reserved", "SPDX-License-Identifier: Apache-2.0", None, "", "nothing here", "cc bye", "© all rights reserved " * 5000]
    scanned = licenses.scan(docs(spark, [(k, t, None) for k, t in enumerate(texts)]))
    got = {r.doc_id: r for r in licenses.summary(scanned).collect()}
    phrases = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
    for k, t in enumerate(texts):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
        places = [(i, lab) for p, lab in phrases.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
        want = (len(words), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None), ",".join(sorted({lab for _, lab in places})))
        assert (got[k].n_words, got[k].n_base, got[k].first_word, got[k].last_word, got[k].base_labels) == want
        assert set(got[k].base_labels.split(",")) - {""} <= set(got[k].labels.split(","))
    assert got[0].labels == "mit" and got[3].labels == "apache-2.0" and got[6].labels == "" and got[6].score == 0 < got[0].score <= 1
    spans = {r.doc_id: r.detections for r in scanned.collect()}
    assert [(d["first"], d["past"]) for d in spans[0]] == [(0, 5)]  # the name inside the notice is suppressed
    assert licenses.scan(docs(spark, [])).count() == 0


def matching(parsed):
    """Every text that a parsed pattern matches, but for a long run of any characters."""
    found = [""]
    for op, arg in parsed:
        if str(op) == "MAX_REPEAT":
            each = matching(arg[2])
            some = ["z z"] if arg[1] > 3 else [t for n in range(arg[0], arg[1] + 1) for t in map("".join, itertools.product(each, repeat=n))]
        elif str(op) == "IN":
            some = [chr(c) for o, v in arg for c in ([v] if str(o) == "LITERAL" else v)]
        else:
            some = {"LITERAL": lambda: [chr(arg)], "SUBPATTERN": lambda: matching(arg[3]), "BRANCH": lambda: [t for b in arg[1] for t in matching(b)], "ANY": lambda: ["z"]}[str(op)]()
        found = [a + b for a in found for b in some]
    return found


def test_keywords_lose_no_match_of_their_rules():
    scanner = licenses.Scanner(licenses.rules())
    for k, rule in enumerate(scanner.table):
        texts = matching(re._parser.parse(rule.pattern))
        assert texts and all(re.fullmatch("[0-9a-z\x80-\uffff ]+", t) and t == " ".join(t.split()) for t in texts)
        assert [t for t in texts if set(rule.keywords.split()).isdisjoint(t.split())] == []
        for t in rng.sample(texts, min(3, len(texts))):
            line = f" {t} ".encode()
            ends = [i for i, c in enumerate(line) if c == 32]
            every = [(ends.index(m.start()), ends.index(m.end()), n) for n, p in enumerate(scanner.patterns) for m in p.finditer(line)]
            assert k in {n for _, _, n in every} and scanner.scan(t.encode())[1] == scanner.settle(every)


@pytest.mark.parametrize(("name", "label"), [("LGPLv3", "lgpl-3.0"), ("AGPLv3", "agpl-3.0"), ("GPL3", "gpl-3.0"), ("GPL2", "gpl-2.0"), ("LGPLv2.1", "lgpl-2.1"), ("Apache2", "apache-2.0"), ("FreeBSD", "bsd-2-clause")])
def test_fused_license_names(name, label):
    scanner = licenses.Scanner(licenses.rules())
    assert [scanner.table[k].label for _, _, k in scanner.scan(f"Licensed under {name}".encode())[1]] == [label]


@pytest.mark.parametrize(
    ("line", "labels"),
    [
        ("SPDX-License-Identifier: GPL-2.0-or-later", {"gpl-2.0"}),
        ("SPDX-License-Identifier: LGPL-2.1-only", {"lgpl-2.1"}),
        ("SPDX-License-Identifier: CC-BY-SA-4.0", {"cc-by-sa", "cc-by"}),
        ("SPDX-License-Identifier: bzip2-1.0.6", {"bzip2-1.0.6"}),
        ("Permission is hereby granted, free of charge, to any person obtaining a copy", {"mit"}),
        ("Redistribution and use in source and binary forms, with or without modification, are permitted", {"bsd"}),
        ("Neither the name of Acme Inc. nor the names of its contributors may be used", {"bsd-3-clause"}),
        ("Licensed under the Apache License, Version 2.0 (the License)", {"apache-2.0"}),
        ("See the GNU General Public License for more details.", {"gpl"}),
        ("You can redistribute it and/or modify it under the terms of the GNU Lesser General Public License", {"lgpl", "gpl"}),  # a base phrase stays
        ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", {"mpl-2.0"}),
        ("http://creativecommons.org/licenses/by-nc/4.0/", {"cc-by-nc"}),
        ("released under CC0 1.0", {"cc0"}),
        ("Distributed under the Boost Software License, Version 1.0.", {"boost-1.0"}),
        ("This is free and unencumbered software released into the public domain.", {"unlicense"}),
        ("No part of this book may be reproduced", {"no-reuse"}),
        ("Copyright (c) 2019 Somebody", {"copyright"}),
        ("the same terms as Perl itself is what it is under", set()),
        ("the boost of the summer was a gift", set()),
        ("we met at the mozilla office to drink beer with an apache pilot", set()),
        ("permission to enter the garden was given by the author", set()),
        ("he is a python trainer and has common public sense", set()),
        ("the general public has no licence to do so", set()),
    ],
)
def test_license_examples(line, labels):
    scanner = licenses.Scanner(licenses.rules())
    assert {scanner.table[k].label for _, _, k in scanner.scan(line.encode())[1]} == labels


def test_rules_are_written_out():
    table = licenses.rules()
    written = [r for r in table if r.name.startswith("rule:")]
    assert len(written) >= 250 and len({r.pattern for r in written}) == len(written) and len({r.name for r in table}) == len(table)


def test_suppression_matches_plain_version():
    scanner = licenses.Scanner(licenses.rules())
    for _ in range(300):
        found = [(a, a + rng.randint(1, 6), rng.randrange(len(scanner.table))) for a in (rng.randrange(12) for _ in range(8))]
        found = sorted(set(found))
        order = sorted(found, key=lambda d: (d[0], -d[1], -scanner.table[d[2]].rank, d[2]))
        want = [d for k, d in enumerate(order) if scanner.table[d[2]].base or not any(o[0] <= d[0] and d[1] <= o[1] and scanner.table[o[2]].rank >= scanner.table[d[2]].rank for o in order[:k])]
        assert scanner.settle(found) == want


def test_column_generation():
    for trial in range(6):
        histogram = {k: rng.randrange(0, 200) for k in rng.sample(range(1, 33), 12)}
        chosen = packing.patterns(histogram, 32)
        used = Counter()
        for times, shape in chosen:
            assert times > 0 and sum(k * n for k, n in shape.items()) <= 32
            for k, n in shape.items():
                used[k] += times * n
        assert used == Counter({k: n for k, n in histogram.items() if n})
        assert sum(t for t, _ in chosen) <= math.ceil(sum(k * n for k, n in histogram.items()) / 32) + 12 + sum(n for k, n in histogram.items() if k > 16)
    assert packing.patterns({}, 8) == [] and packing.patterns({8: 3}, 8) == [(3, {8: 1})]
    value, counts = packing.knapsack(np.array([1.0, 3.0, 4.0]), 7)
    assert value == 10.0 and sum((k + 1) * n for k, n in enumerate(counts)) <= 7


def check_packed(rows, want, length=2048):
    """``want``: id and end-closed id bytes of each document."""
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
    for some in sequences.values():
        at = 0
        for r in sorted(some, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= length
    pieces = Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows)
    cut = Counter((i, s, len(b[4 * s : 4 * s + 4 * length]) // 4, zlib.crc32(b[4 * s : 4 * s + 4 * length]), len(b) // 4) for i, b in want for s in range(0, len(b) // 4, length))
    assert pieces == cut


def test_packing(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    want = [(i, np.array(library.encode(t or "", add_special_tokens=False).ids + [1], "<u4").tobytes()) for i, t, _ in ROWS]
    check_packed(packing.pack(docs(spark, ROWS), path).collect(), want)
    assert packing.pack(docs(spark, []), path).count() == 0
    unique = {i: (i, t, lang) for i, t, lang in ROWS if i is not None}
    pieces = packing.cut(docs(spark, list(unique.values())), path, length=256)
    placed = packing.place(pieces, length=256)
    whole = {r.sequence_id: r.ids for r in packing.sequences(pieces, placed).collect()}
    assert all(zlib.crc32(bytes(whole[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)])) == r.ids_crc32 for r in placed.collect())


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rows = [(k, text(rng.randint(30, 90)), ["en", "de"][k % 2]) for k in range(60)]
    rows += [(100, rows[3][1], "en"), (101, "123 !!", "en"), (102, None, "de")]
    spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, 1, 0) for k in range(0, 60, 2)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "mix", "pack"]
    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")
    left = {r.doc_id for r in corpus_pipeline.near_dedup(spark, corpus_pipeline.language_id(spark, frame, ""), "").collect()}
    assert 3 in left and not left & {100, 101, 102}
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    times = Counter(r.doc_id for r in got if r.start == 0)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert set(times) <= left
    check_packed(got, [(i, np.array(library.encode(t, add_special_tokens=False).ids + [1], "<u4").tobytes()) for i, t, _ in rows for _ in range(times[i])])
