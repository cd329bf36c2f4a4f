import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusweft.llm import components, license_scan, lm_score, mixing, near_dedup, pieces, quality_model, quality_rules, suffix_dedup, token_counts, vp_search
from corpusweft.llm.docstats import doc_stats
from corpusweft.llm.shared import new_path
from corpusweft.llm.textops import raw

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, extra string"
ODD = [(1, None, None, None, None, "x"), (2, "", "en", "a", 0, None), (3, "one", "en", "a", 3, "x"), (3, "one", "en", "a", 3, "x"), (None, "null id here", "en", None, 12, "x"), (4, "é€😀 \t\r\n z", "fr", "b", 9, "x"), (5, "long word " * 30_000, "en", "a", 300_000, "x"), (6, "x" * 200_000, "en", "a", 200_000, "x")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def brute_nearest(x, ids, k=20, modulus=20):
    out = {}
    for i in ids:
        if i % modulus == 0:
            s = np.zeros(len(x))
            for j in range(x.shape[1]):
                s = s + x[i, j] * x[:, j]
            order = [n for n in np.lexsort((np.arange(len(x)), -s)) if n != i][:k]
            out[i] = [(r + 1, int(n), s[n]) for r, n in enumerate(order)]
    return out


def found_nearest(df):
    got = {}
    for r in df.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return got


def test_vp(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 8)).round(2)
    x[50:120] = x[50]  # a hot group of copies
    rows = [(i, v.tolist(), "x") for i, v in enumerate(x)] + [(1000, None, "x"), (1001, [0.0] * 8, "x"), (1002, [float("nan")] * 8, "x"), (1003, [1.0], "x"), (None, x[0].tolist(), "x")]
    e = spark.createDataFrame(rows, "vec_id long, embedding array<double>, shard string")
    want = brute_nearest(x, range(400))
    for shard_rows, factor, least in ((10_000, 1.0, 1.0), (60, 1.0, 1.0), (60, 1.25, 0.9)):
        got = found_nearest(vp_search.nearest(e, factor=factor, shard_rows=shard_rows, leaf=16))
        recall = np.mean([len({k for _, k, _ in got[q]} & {k for _, k, _ in want[q]}) / 20 for q in want])
        assert recall >= least and (least < 1 or got == want)
    assert vp_search.nearest(e.where("vec_id > 999")).count() == 0


def test_vp_ties(spark):
    x = np.array([[(i >> b) & 1 for b in range(9)] for i in range(1, 512)], float)
    e = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    for shard_rows in (10_000, 100):
        assert found_nearest(vp_search.nearest(e, factor=1.0, shard_rows=shard_rows, leaf=16)) == brute_nearest(x, range(511))


@pytest.mark.parametrize("dim,n", [(8, 2000), (64, 2000), (768, 600)])
def test_vp_recall_at_the_default(spark, dim, n):
    rng = np.random.default_rng(dim)
    x = rng.normal(size=(n, dim)) + 0.5 * rng.normal(size=(20, dim))[rng.integers(0, 20, n)]
    e = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    want = {q: {k for _, k, _ in v} for q, v in brute_nearest(x, range(n)).items()}
    got = found_nearest(vp_search.nearest(e, shard_rows=500))
    assert np.mean([len({k for _, k, _ in got[q]} & want[q]) / 20 for q in want]) >= 0.9


def test_tokens(spark, odd, empty):
    enc = token_counts.tokenizer("/opt/tokenizers/byte_bpe_50k.tiktoken").encode_ordinary
    t = token_counts.TokenRollup(spark, new_path(spark, "t"))
    ins = token_counts.inserts(odd)
    assert t.totals().count() == 0 and t.apply("a", ins) and not t.apply("a", ins) and t.apply("none", token_counts.inserts(empty))
    total = lambda: {(r["source"], r["lang"]): (r["n_docs"], r["n_tokens"], r["n_bytes"]) for r in t.totals().collect()}
    first = total()
    assert first[None, "en"][:2] == (1, len(enc("null id here"))) and first[None, None] == (1, 0, 0) and sum(v[0] for v in first.values()) == 8
    change = spark.createDataFrame([("D", 3, "a", "en", None), ("R", 4, "c", "fr", "new text"), ("D", 99, None, None, None)], "op string, doc_id long, source string, lang string, text string")
    assert t.apply(".b/x", change) and not t.apply(".b/x", change)
    second = total()
    assert ("b", "fr") not in second and second["c", "fr"] == (1, len(enc("new text")), 8) and second["a", "en"][0] == first["a", "en"][0] - 2


def test_tokens_within_a_batch(spark):
    rows = [("I", 1, 1, "a", "x y"), ("D", 1, 2, "a", None), ("R", 2, 1, "a", "x"), ("R", 2, 2, "a", "x y z"), ("D", 3, 1, "a", None), ("I", 3, 2, "b", "x"), ("R", 4, None, "c", "x y"), ("R", 4, None, "c", "x"), ("I", 5, None, "c", "x"), ("D", 5, None, "c", None), ("?", 6, None, "c", "x")]
    t = token_counts.TokenRollup(spark, new_path(spark, "t"), token_counts.WORDS)
    assert t.apply("one", spark.createDataFrame([(*r, "en") for r in rows], "op string, doc_id long, seq long, source string, text string, lang string"))
    assert {(r["source"], r["n_docs"], r["n_tokens"]) for r in t.totals().collect()} == {("a", 1, 3), ("b", 1, 1), ("c", 1, 1)}


def test_tokens_of_two_writers(spark):
    d = spark.createDataFrame([(1, "a", "en", "x y"), (2, "a", "en", "x")], "doc_id long, source string, lang string, text string")
    path = new_path(spark, "t")
    one, two = (token_counts.TokenRollup(spark, path, token_counts.WORDS) for _ in range(2))
    one.apply("first", token_counts.inserts(d))
    write = two._write

    def late(*args):  # another writer commits the same number meanwhile
        write(*args)
        two._write = write
        one.apply("other", token_counts.changed(d, "R", source=F.lit("b")))

    two._write = late
    assert two.apply("mine", token_counts.changed(d.where("doc_id = 1"), "D"))
    assert [tuple(r) for r in two.totals().collect()] == [("b", "en", "words", 1, 1, 1)] and len(two.commits()) == 3


def test_rollup_of_every_kind(spark, odd):
    got = token_counts.rebuilt(token_counts.TokenRollup(spark, new_path(spark, "t"), token_counts.WORDS), odd)
    assert {(r["source"], r["lang"]): (r["n_docs"], r["n_tokens"]) for r in got.collect()} == {(None, None): (1, 0), ("a", "en"): (5, 60_003), (None, "en"): (1, 3), ("b", "fr"): (1, 2)}


def unigram_model():
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    rnd = random.Random(1)
    m.trainer_spec.model_type, m.trainer_spec.unk_id = 1, 0
    m.normalizer_spec.name, m.normalizer_spec.add_dummy_prefix, m.normalizer_spec.remove_extra_whitespaces, m.normalizer_spec.escape_whitespaces = "identity", True, False, True
    words = {"".join(rnd.choice("abc") for _ in range(n)) for n in (1, 2, 3, 4) for _ in range(20)} | {"a", "b", "c"}
    for piece, kind in [("<unk>", 2), ("<s>", 3), ("</s>", 3), ("\u2581", 1), *[(w, 1) for w in sorted(words)], *[("\u2581" + w, 1) for w in sorted(words)[::2]]]:
        p = m.pieces.add()
        p.piece, p.type, p.score = piece, kind, -rnd.random() * 10
    return m.SerializeToString()


def test_pieces_of_a_unigram_model(spark, tmp_path):
    (tmp_path / "m").write_bytes(unigram_model())
    rnd = random.Random(4)
    texts = [(i, "".join(rnd.choice(a) for _ in range(700))) for i, a in enumerate(["abc", "abc ", "aab c", "a"])]
    e = pieces.encode(spark.createDataFrame(texts, "doc_id long, text string"), str(tmp_path / "m"), giant=120, chunk=90, fan=2, keep=())
    m = pieces.load(str(tmp_path / "m"))
    score = lambda ids: sum(m.score[p] for p in m.lib.id_to_piece(ids))
    for r in e.collect():  # ties apart, the best path
        text = texts[r["doc_id"]][1]
        assert m.lib.decode(r["ids"]) == text and abs(score(r["ids"]) - score(m.lib.encode(text))) < 1e-3


def test_pieces_long_texts_and_names(spark, odd):
    d = odd.withColumns({"h": F.lit("mine"), "key": F.lit("too"), "_text": F.lit(1)})
    e = pieces.encode(d, keep=("h", "key", "_text", "text")).collect()
    lib = pieces.load(pieces.MODEL).lib
    assert len(e) == 8 and {(r["h"], r["key"], r["_text"]) for r in e} == {("mine", "too", 1)}
    assert all(list(r["ids"]) == lib.encode(r["text"] or "") for r in e)


@pytest.mark.parametrize("chunk", [160, 1000])
def test_pieces(spark, odd, docs, chunk):
    lib = pieces.load(pieces.MODEL).lib
    rnd = random.Random(2)
    more = [(100 + i, "".join(rnd.choice(a) for _ in range(n)), "en", "a", n, None) for i, (a, n) in enumerate([("theandi", 2500), ("ab ", 900), ("a", 700), ("日本語の", 800), (" ", 600), ("x\n", 500)])]
    d = spark.createDataFrame(more, SCHEMA).unionByName(docs.limit(20).withColumn("extra", F.lit("x"))).unionByName(odd.where("doc_id is null or doc_id < 5"))
    d.cache()
    e = pieces.encode(d, giant=chunk + 40, chunk=chunk, fan=3)
    texts = sorted((r["doc_id"] or -1, r["text"] or "") for r in d.collect())
    assert sorted(((r["doc_id"] or -1, list(r["ids"])) for r in e.collect())) == sorted((i, lib.encode(t)) for i, t in texts)
    assert sorted((r["doc_id"] or -1, r["text"]) for r in pieces.decode(e).collect()) == texts
    assert pieces.encode(d.limit(0)).count() == 0


def test_pieces_of_a_column_and_their_texts(spark):
    m, rnd = pieces.load(pieces.MODEL), random.Random(3)
    some = ["a", "b", " ", "  ", "\n", "\u2581", "é", "😀", "\t", "\r", " the", "world", ".", "\x00", "ﬀ"]
    texts = ["".join(rnd.choices(some, k=rnd.randint(0, 25))) for _ in range(300)] + ["", " ", "\n", "x" * 40_000]
    want = {i: (m.lib.encode(t), t.replace(pieces.MARK, " ")) for i, t in enumerate(texts)}
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = pieces.encode(rows, keep=("text",), decoded="text")
    assert got.columns == ["doc_id", "ids", "text"] and {r["doc_id"]: (list(r["ids"]), r["text"]) for r in got.collect()} == want
    for t in texts:
        t = m.normal(t).replace(pieces.MARK, " ")
        starts = pieces.unit_starts(*raw(pa.array([t])))
        assert [x.tobytes().decode() for x in np.split(np.frombuffer(t.encode(), np.uint8), starts[1:])] == ([u.replace(pieces.MARK, " ") for u in m.units.findall(t.replace(" ", pieces.MARK))] or [""])
    bad = np.array([m.bytes["<0xC3>"], m.bytes["<0xA9>"], m.bytes["<0xC3>"], *m.lib.encode("x")], np.int32)
    off = np.array([0, 2, 2, 3, len(bad)])
    assert m.texts(bad, off).to_pylist() == [m.decode(bad[a:b]).decode("utf-8", "replace")[1:] for a, b in zip(off[:-1], off[1:])]


def test_equal_texts_are_encoded_once(monkeypatch):
    m, seen = pieces.load(pieces.MODEL), []
    own = pieces.Pieces._encode
    monkeypatch.setattr(pieces.Pieces, "_encode", lambda self, texts: seen.append(len(texts)) or own(self, texts))
    ids, off = m.encode_column(pa.array(["one two", "three", "one two", "", "three"]))
    assert seen == [3]
    assert [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:])] == [m.lib.encode(t) for t in ("one two", "three", "one two", "", "three")]


def test_maxplus_is_associative():
    rng = np.random.default_rng(1)
    a, b, c = rng.normal(size=(3, 4)), rng.normal(size=(4, 2)), rng.normal(size=(2, 5))
    assert np.allclose(pieces.times(pieces.times(a, b), c), pieces.times(a, pieces.times(b, c)))
    states = pieces.choose([a, b, c], 1, 3)
    assert np.isclose(a[states[0], states[1]] + b[states[1], states[2]] + c[states[2], states[3]], pieces.times(pieces.times(a, b), c)[1, 3])


def test_suffix(spark, odd, empty):
    rnd = random.Random(4)
    words = ["".join(rnd.choice("abcdeé") for _ in range(5)) for _ in range(60)]
    text = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    passage, rows = text(20), []
    for i in range(40):
        t = text(rnd.randrange(1, 60))
        rows.append((i, t[: len(t) // 2] + (passage[rnd.randrange(20) :] if i % 3 else passage) + t[len(t) // 2 :]))
    rows += [(100, rows[3][1]), (101, rows[3][1][7:90]), (102, "z" * 300), (103, "z" * 120), (104, ""), (105, "y" * 49), (106, "y" * 50), (107, "y" * 50)]
    rows += [(7, rows[9][1]), (7, text(40)), (None, rows[9][1]), (9, rows[9][1])]  # texts that share a doc_id
    want = sorted(suffix_dedup.brute_force([(i, t.encode()) for i, t in rows if i is not None]))
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    small = {"held_bytes": 3000, "bucket_bytes": 2000, "most_partitions": 2}  # several buckets a partition, which overflow
    for options in ({}, {"passes": 1}, {"passes": 3} | small, {"passes": 1} | small):
        got = suffix_dedup.suffix_dedup(d, **options).collect()
        assert sorted(tuple(r) for r in got if r[0] is not None) == want and [tuple(r)[2:4] for r in got if r[0] is None] == [(0, 0)]
    got = {(r["doc_id"], r["n_bytes"], r["n_removed"]) for r in suffix_dedup.suffix_dedup(odd).collect()}
    assert (None, 12, 0) in got and (1, 0, 0) in got and (6, 200_000, 0) in got
    named = odd.withColumns({"_spans": F.lit(1), "_row": F.lit("r"), "row": F.lit(2)})
    cut = suffix_dedup.deduplicated(named)
    assert cut.columns == named.columns and cut.count() == 8 and suffix_dedup.suffix_dedup(empty).count() == 0
    assert {(r["_spans"], r["_row"], r["row"]) for r in cut.collect()} == {(1, "r", 2)}


def test_suffix_keeps_unique_text_of_a_shared_id(spark):
    unique, repeat = "this text stands nowhere else in the whole table, not one bit of it, which is so, really", "a passage that two documents hold, word for word and letter for letter, to its very end"
    d = spark.createDataFrame([(1, repeat), (2, repeat), (2, unique)], "doc_id long, text string")
    assert sorted(r["text"] for r in suffix_dedup.deduplicated(d).collect()) == ["", repeat, unique]


def test_suffix_sorts_only_what_can_match(spark, monkeypatch):
    rng, letters = random.Random(9), "abcdefghijklmnopqrstuvwxyz"
    words = lambda n: " ".join("".join(rng.choices(letters, k=7)) for _ in range(n))
    common, copied = [words(3) for _ in range(10)], words(12)
    rows = [(i, " ".join(f"{words(3)} {x}" for x in common * 3)) for i in range(40)] + [(50 + i, f"{words(9)} {copied} {words(9)}") for i in range(3)]
    b, off = raw(pa.array([t for _, t in rows]))
    ids = np.array([i for i, _ in rows])
    r, sorted_rows, plain = suffix_dedup.records(ids, ids, b, off, 0, 1), [], suffix_dedup.sorted_bucket
    monkeypatch.setattr(suffix_dedup, "sorted_bucket", lambda x: sorted_rows.append(len(x)) or plain(x))
    spans = suffix_dedup.bucket_spans(r)
    assert set(spans["doc"].tolist()) == {51, 52} and 5 * sum(sorted_rows) < len(suffix_dedup._shared(r))
    monkeypatch.undo()
    got = suffix_dedup.suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == sorted(suffix_dedup.brute_force([(i, t.encode()) for i, t in rows]))


def test_lm(spark, docs, odd, empty):
    bench = docs.where("doc_id % 7 = 0")
    r = {x["doc_id"]: x for x in lm_score.cross_entropy_difference(docs, bench).collect()}
    inside = np.mean([r[i]["score"] for i in r if i % 7 == 0 and r[i]["n_tokens"] > 50])
    outside = np.mean([r[i]["score"] for i in r if i % 7 and r[i]["n_tokens"] > 50])
    assert inside > outside and len(r) == docs.select("doc_id").distinct().count()
    x = {a["doc_id"]: a for a in lm_score.cross_entropy_difference(odd, empty).collect()}
    assert x[1]["n_tokens"] == 0 and x[1]["score"] == 0 and x[1]["target_loss"] is None
    assert lm_score.cross_entropy_difference(empty, odd).count() == 0


@pytest.mark.parametrize("slots", [0, 500, 1 << 22])
def test_lm_uses_every_bigram(spark, docs, odd, slots):
    from collections import Counter
    from math import log

    enc = token_counts.tokenizer("/opt/tokenizers/byte_bpe_50k.tiktoken").encode_ordinary
    d = docs.limit(60).withColumn("extra", F.lit("x")).unionByName(odd)
    bench = docs.where("doc_id % 7 = 0").limit(9)
    pairs = lambda text: list(zip([lm_score.START, *(t := enc(text or ""))], t))
    rows, target = [(r["doc_id"], pairs(r["text"])) for r in d.collect()], [pairs(r["text"]) for r in bench.collect()]
    models = []
    for texts in (target, [p for _, p in rows]):
        n, c, u = Counter(), Counter(), Counter()
        for p in texts:
            n.update(p), c.update(a for a, _ in p), u.update(b for _, b in p)
        models.append((n, c, u, sum(u.values()) + lm_score.PRIOR * lm_score.VOCABULARY))
    loss = lambda p, m: -sum(log((m[0][a, b] + lm_score.SPREAD * (m[2][b] + lm_score.PRIOR) / m[3]) / (m[1][a] + lm_score.SPREAD)) for a, b in p) / len(p)
    want = sorted((i or 0, len(p), *([loss(p, m) for m in models] if p else [-1, -1])) for i, p in rows)
    got = sorted((r["doc_id"] or 0, r["n_tokens"], *([r["target_loss"], r["background_loss"]] if r["n_tokens"] else [-1, -1])) for r in lm_score.lm_scores(d, lm_score.fit(bench, d, slots=slots)).collect())
    assert len(got) == len(want) and [(g, w) for g, w in zip(got, want) if not np.allclose(g, w, rtol=1e-9, atol=1e-9)] == []


def test_mix(spark, odd, empty, docs):
    got = mixing.mix(odd).collect()
    assert len(got) == 8 and all(r["taken"] <= 2 * r["size"] for r in got) and mixing.mix(empty).count() == 0
    rows = mixing.mix(docs).collect()
    by = {}
    for r in rows:
        s = by.setdefault((r["source_size"], r["target"]), [0, 0])
        s[0] += r["taken"]
        s[1] = max(s[1], r["size"])
    assert all(abs(taken - target) <= 2 * most for (_, target), (taken, most) in by.items())
    equal = odd.where("doc_id = 3").limit(1).crossJoin(spark.range(5).select(F.lit("r").alias("_rid"), F.lit("c").alias("_copy"), F.lit(7).alias("_h")))
    more = equal.unionByName(odd.withColumns({"_rid": F.lit("r"), "_copy": F.lit("c"), "_h": F.lit(7)}))
    for d in (odd, more):  # equal rows, and names that the operator might use
        out = mixing.mixed(d)
        assert out.columns == d.columns and out.count() == sum(r["taken"] // r["size"] for r in mixing.mix(d).collect() if r["size"])


def test_mix_equals_sql(spark, sf, docs):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = sorted(con.execute(mixing.MIX_SQL).fetchall())
    assert sorted(tuple(r) for r in mixing.mix(docs).collect()) == want


def brute_stats(t):
    import re

    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    lines, seen, dup = (t or "").split("\n"), set(), 0
    for x in lines:
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in seen
            seen.add(x)
    grams = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    hit = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(i, i + 8)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), dup, len(hit)


def test_rules(spark, odd, empty, docs):
    texts = [r["text"] for r in docs.limit(60).collect()] + ["", "a\nb\na\n \n \n", "w " * 40, None]
    s = doc_stats(pa.array(texts))
    assert [tuple(int(s[c][i]) for c in quality_rules.COUNTS) for i in range(len(texts))] == [brute_stats(t) for t in texts]
    got = quality_rules.quality_rules(odd).collect()
    assert len(got) == 8 and [r["kept"] for r in got if r["doc_id"] in (1, 2, 3)] == [False] * 4 and quality_rules.quality_rules(empty).count() == 0


def test_rules_equal_sql(spark, sf, docs):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = sorted(con.execute(quality_rules.BASE_SQL).fetchall())
    assert sorted(tuple(r) for r in quality_rules.base_counts(docs).collect()) == want


def plain_mcd(x, share, starts=50, seed=3):
    """FAST-MCD: random starts, concentration to the end, the smallest determinant, one reweighting."""
    rng, best = np.random.default_rng(seed), None
    h, p = int(np.ceil(share * len(x))), x.shape[1]
    for _ in range(starts):
        rows = rng.choice(len(x), p + 2, replace=False)
        for _ in range(30):
            c, s = x[rows].mean(0), np.cov(x[rows].T, bias=True) + 1e-12 * np.eye(p)
            rows = np.argsort(np.einsum("ij,jk,ik->i", x - c, np.linalg.inv(s), x - c))[:h]
        c, s = x[rows].mean(0), np.cov(x[rows].T, bias=True)
        if best is None or np.linalg.det(s) < best[0]:
            best = (np.linalg.det(s), c, s * quality_rules.consistency(share))
    _, c, s = best
    near = np.einsum("ij,jk,ik->i", x - c, np.linalg.inv(s), x - c) <= quality_rules.quantile(1 - quality_rules.REWEIGHTED)
    return x[near].mean(0), np.cov(x[near].T, bias=True) * quality_rules.consistency(quality_rules.REWEIGHTED)


def test_mcd_equals_plain_mcd(spark):
    rng = np.random.default_rng(8)
    mix = rng.normal(size=(4, 4)) * 0.4
    x = (rng.normal(size=(3000, 4)) @ mix + 1.0) * 0.3
    x[:400] = rng.normal(size=(400, 4)) * 0.2 + np.array([6.0, -4.0, 5.0, 0.0])  # a cluster of outliers
    d = spark.createDataFrame([("en", "a", *v) for v in x.tolist()], ["lang", "source", *quality_rules.DIMS])
    got = quality_rules.mcd(d).where("level = 2").first()
    centre, cov = plain_mcd(x, quality_rules.KEPT_SHARE)
    assert np.allclose(got["centre"], centre, atol=0.03) and np.allclose(np.reshape(got["cov"], (4, 4)), cov, atol=0.06 * np.abs(cov).max())
    assert np.array([(quality_rules.SINGULAR * v) ** 2 for v in quality_rules.USUAL.values()]).max() < 0.1 * np.diag(cov).min()
    assert abs(quality_rules.quantile(0.05) - 9.4877) < 1e-3 and abs(quality_rules.consistency(0.75) - 1.486) < 0.01


def test_rules_reject_junk_only(spark, sf):
    d = sf.replace("sf0.001", "sf0.01")
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    r = quality_rules.quality_rules(docs).where("not base_failed").join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("double"))).collect()
    by = {x[0]: x[1] for x in r}
    assert by[1] >= 0.99 and by[0] <= 0.1


def brute_classes(rows):
    keyed = {}
    for i, t in rows:
        keyed.setdefault(t or "", []).append(i)
    reps = [(min(v), set(zip(*[t.split()[k:] for k in range(5)])) or ({tuple(t.split())} if t.split() else set())) for t, v in keyed.items()]
    up = {i: i for i, _ in reps}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for n, (i, a) in enumerate(reps):
        for j, b in reps[:n]:
            if a and b and len(a & b) >= 0.8 * len(a | b):
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    return {i: root(min(v)) for v in keyed.values() for i in v}


def test_near(spark, odd, empty):
    rnd = random.Random(9)
    rows, n = [], 0
    for _ in range(12):
        base = [rnd.choice("abcdefghijklmnop") * rnd.randrange(1, 5) for _ in range(rnd.choice([3, 30, 200]))]
        for _ in range(6):
            w = base[:]
            for _ in range(rnd.randrange(0, 1 + len(w) // 40)):
                w[rnd.randrange(len(w))] = "changed"
            rows.append((n, " ".join(w)))
            n += 1
    rows += [(n, ""), (n + 1, None), (n + 2, "one"), (n + 3, "one ")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r[0]: r[1] for r in near_dedup.near_duplicates(d).collect()} == brute_classes(rows)
    assert near_dedup.near_duplicates(odd).count() == 8 and near_dedup.near_duplicates(empty).count() == 0
    kept = near_dedup.one_of_each(odd)
    assert kept.columns == odd.columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 3, 4, 5, 6]


def test_near_long_texts_exactly(spark):
    rnd = random.Random(3)
    rows = []
    for k in range(12):  # similarity 0.8016 or 0.7982, of about 3,000 shingles
        a = [str(rnd.randrange(10**9)) for _ in range(3000)]
        b = a[:]
        for at in range(66 + k % 2):
            b[10 + 40 * at] = "changed"
        rows += [(2 * k, " ".join(a)), (2 * k + 1, " ".join(b))]
    got = {r[0]: r[1] for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute_classes(rows)
    assert got == want and len(set(want.values())) == 18


def test_near_short_texts(spark):
    rnd = random.Random(6)
    rows = []
    for k in range(150):  # 8 words and the same with one more: 4 of 5 shingles
        w = [str(rnd.randrange(10**6)) for _ in range(9)]
        rows += [(2 * k, " ".join(w[:8])), (2 * k + 1, " ".join(w))]
    got = {r[0]: r[1] for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_classes(rows) and set(got.values()) == {2 * k for k in range(150)}


def test_blocks_of_families(spark):
    rnd = random.Random(7)
    base = [str(rnd.randrange(10**6)) for _ in range(60)]
    rows = [(i, " ".join(w if rnd.random() > 0.01 else "changed" for w in base)) for i in range(60)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    s = near_dedup.sketches(d).select(F.lit(1).cast("long").alias("family"), F.col("doc_id").alias("id"), "sketch", "sample")
    whole, parts = (components.components(near_dedup.verified_links(s, block=b).where("sure").select("a", "b")) for b in (1000, 7))
    assert near_dedup.dealt(s, 7).select("task").distinct().count() > 20 and sorted(map(tuple, whole.collect())) == sorted(map(tuple, parts.collect()))


def test_split_buckets_keep_pairs():
    rng = np.random.default_rng(1)
    for m in (1200, 20_000):  # pairs at 15 % bit distance in one bucket that is cut
        bits = rng.integers(0, 2, (m, near_dedup.BITS), dtype=np.uint8)
        bits[1:600:2] = bits[0:600:2] ^ (rng.random((300, near_dedup.BITS)) < 0.15)
        order = rng.permutation(m)
        at = np.argsort(order)
        link = near_dedup.Linker(np.packbits(bits[order], axis=1).view(np.uint64), near_dedup.LOOSE)
        link.runs(np.zeros(m, np.int64))
        assert np.mean([link.forest.root(int(at[k])) == link.forest.root(int(at[k + 1])) for k in range(0, 600, 2)]) >= 0.98


def test_cut_buckets_compare_short_runs_at_once():
    calls = []

    class Counted(near_dedup.Linker):
        def run(self, rows, level=1):
            calls.append(len(rows))
            super().run(rows, level)

    sketch = np.random.default_rng(6).integers(0, 2**63, (2 * 1500, near_dedup.BITS // 64), dtype=np.uint64)
    sketch[7], sketch[1600] = sketch[3] ^ np.uint64(255), sketch[1550]
    link = Counted(sketch, near_dedup.LOOSE)
    link.runs(np.repeat([0, 1], 1500))
    assert sorted(zip(link.a, link.b)) == [(3, 7), (1550, 1600)]
    assert len(calls) < 20  # one call for each cut run of two or more rows: up to 5,120 a bucket


def test_word_hashes_tell_words_apart():
    words = ["", "a", "a\0", "\0a", "a" * 8, "a" * 8 + "\0", "a" * 128, "a" * 129, "a" * 130, "é", "b" * 9, "c" + "b" * 8]
    h = near_dedup._short_hashes(pa.array(["x", *words, *words]))[1:]
    assert len(set(h.tolist())) == len(words) and (h[: len(words)] == h[len(words) :]).all()


def test_large_buckets_are_cut_before_the_shuffle(spark):
    rng = np.random.default_rng(2)
    rows = [(i, bytearray(rng.bytes(near_dedup.BITS // 8))) for i in range(300)] + [(300 + i, bytearray(b"\x01" * 32)) for i in range(5)]
    d = spark.createDataFrame(rows, "id long, sketch binary")
    assert near_dedup.loose_links(near_dedup.bucketed(d, 3)).where("a >= 300").select("b").distinct().count() >= 1


def test_a_hundred_thousand_near_equal_texts():
    rng = np.random.default_rng(3)
    bits = rng.integers(0, 2, near_dedup.BITS, dtype=np.uint8)[None] ^ (rng.random((100_000, near_dedup.BITS)) < 0.03)
    link = near_dedup.Linker(np.packbits(bits, axis=1).view(np.uint64), near_dedup.LOOSE)
    link.runs(np.zeros(100_000, np.int64))
    assert len(link.a) == 99_999


def test_components(spark):
    rounds = []
    chain = spark.range(10_000).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert components.components(chain, rounds).groupBy("component").count().collect() == [(0, 10_001)] and rounds[0] <= 2
    rnd = random.Random(5)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(1000, i) for i in range(500, 560)]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        if a != b:
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    got = components.components(spark.createDataFrame(links, "a long, b long"))
    assert dict(map(tuple, got.collect())) == {x: root(x) for x in up}
    assert components.components(chain.limit(0)).count() == 0


def test_license(spark, odd, empty):
    rows = [(1, "Foo. CC-BY x; all Rights\nreserved! cc by"), (2, "Permission is hereby granted, free of charge, to any lucky person obtaining a copy of this software and associated documentation files"), (3, None), (4, "released under the MIT license"), (5, "GENERAL public license é9"), (6, "cc by cc by"), (4, "nothing here"), (7, "this work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"), (8, "licensed under the moon"), (9, "Permission is granted, free of charge, to any person obtaining a copy of this software and documentation files")]
    every = license_scan.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = {r["doc_id"]: r for r in every if r["doc_id"] != 4 or r["n_words"] > 2}
    assert [(r["labels"], r["score"]) for r in every if r["n_words"] == 2] == [("", 0.0)] and got[7]["labels"] == "cc-by-nc" and got[8]["labels"] == ""
    f = lambda i: (got[i]["n_words"], got[i]["n_base"], got[i]["first_word"], got[i]["last_word"], got[i]["base_labels"], got[i]["labels"])
    assert f(1) == (9, 3, 1, 7, "cc-by,reserved", "cc-by,reserved") and f(3) == (0, 0, None, None, "", "") and f(5)[1:] == (1, 0, 0, "gpl", "gpl") and f(6)[:4] == (4, 2, 0, 2)
    assert got[2]["labels"] == "mit" and got[2]["score"] == 1 and got[9]["labels"] == "mit" and 0.6 <= got[9]["score"] < 1 and got[4]["labels"] == "mit" and got[4]["score"] == 1 and got[3]["score"] == 0
    assert license_scan.license_scan(odd).count() == 8 and license_scan.license_scan(empty).count() == 0


def test_license_templates_table(spark):
    own = spark.createDataFrame([("house", "these words belong to the house and to nobody else at all")], "label string, text string")
    d = spark.createDataFrame([(1, "he said: these words belong to the house, and to NOBODY else at all."), (2, "these words belong to us")], "doc_id long, text string")
    assert [r["labels"] for r in license_scan.license_scan(d, own).orderBy("doc_id").collect()] == ["house", ""]


def test_license_equals_sql(spark, sf, docs):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = sorted(con.execute(license_scan.license_sql()).fetchall(), key=repr)
    assert sorted(map(tuple, license_scan.license_scan(docs).collect()), key=repr) == want


def test_classifier(spark, odd, empty, docs, sf):
    d = sf.replace("sf0.001", "sf0.01")  # enough labels to learn from
    labels, docs = spark.read.parquet(f"{d}/labels.parquet"), spark.read.parquet(f"{d}/documents.parquet")
    r = quality_model.quality_scores(docs, labels).where("held_out").join(labels, "doc_id")
    assert r.where("predicted = quality").count() >= 0.95 * r.count()
    none = labels.limit(0)
    assert {x["score"] for x in quality_model.quality_scores(odd, none).collect()} == {0.5}
    assert quality_model.quality_scores(odd, labels).count() == 8 and quality_model.quality_scores(empty, labels).count() == 0
    good = quality_model.good_documents(odd, labels)
    assert good.columns == odd.columns


def test_features_for_training_are_of_chosen_rows_only(spark, docs, sf, monkeypatch):
    labels, rows = spark.read.parquet(f"{sf}/labels.parquet"), []
    own = quality_model.feature_table

    def counted(d):
        rows.append((d.count(), d._jdf.queryExecution().toString()))
        return own(d)

    monkeypatch.setattr(quality_model, "feature_table", counted)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = sorted(r["doc_id"] for r in quality_model.good_documents(docs, labels, most=25).collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows[0][0] == 25 and "SortMergeJoin" not in rows[0][1]  # texts aren't sent
    forest = quality_model.fit(own(docs), labels, 25)
    x = quality_model.features(pa.array([r["text"] for r in docs.collect()]))
    assert kept == sorted(r["doc_id"] for r, s in zip(docs.collect(), forest.scores(x)) if s >= quality_model.THRESHOLD)


def test_distinct_words_of_texts():
    rnd = random.Random(5)
    texts = [" ".join(rnd.choice("abcdefgh") for _ in range(n)) for n in (0, 1, 19, 20, 45, 300)]
    s, split = doc_stats(pa.array(texts)), [t.split() for t in texts]
    assert s["n_distinct"].tolist() == [len(set(w)) for w in split]
    assert s["variety"].tolist() == [sum(len(set(w[i : i + 20])) for i in range(0, len(w) // 20 * 20, 20)) for w in split]


def test_forest():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 4)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 2] > 0.3)).astype(float)
    f = quality_model.train(x, y)
    x2 = rng.normal(size=(500, 4)).astype(np.float32)
    assert ((f.scores(x2) > 0.5) == ((x2[:, 0] > 0) ^ (x2[:, 2] > 0.3))).mean() > 0.93


def test_scores_equal_a_walk_down_each_tree(spark, docs, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    forest = quality_model.fit(quality_model.feature_table(docs), labels)
    rows = docs.limit(40).collect()
    x = quality_model.features(pa.array([r["text"] for r in rows]))
    got = {r["doc_id"]: r["score"] for r in quality_model.quality_scores(docs, labels).collect()}
    for row, v in zip(rows, x):
        total = forest.base
        for feature, cut, leaf in zip(forest.feature, forest.cut, forest.leaf):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if v[feature[node]] > cut[node] else 1)
            total += leaf[node - len(feature)]
        assert abs(got[row["doc_id"]] - 1 / (1 + np.exp(-total))) < 1e-9


def test_classifier_with_repeated_ids(spark, docs, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    twice = docs.unionByName(docs.withColumn("text", F.reverse("text")))
    one, two = (sorted(map(tuple, quality_model.quality_scores(twice.repartition(n), labels).collect())) for n in (2, 5))
    assert one == two
