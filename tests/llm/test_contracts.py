"""Odd inputs, clashing names, SQL and the pipeline of the training-data operators."""

import random
import struct
import sys
from array import array
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import cotraining, jaccard, language_id, line_dedup, mixing, packing, quality_rules, queries, token_files

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))
import corpus_pipeline  # noqa: E402

DATA = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Every working column of the stages.
INNER = "row did th batch pos line key gone keeper docs h1 h2 more found size class source_size target p whole edge last key_ each rest _source _of _s _b q bucket before copy mix_copies mix_size n_lines n_dropped cotrain_score cotrain_kept component_id n_shingles node rep a b salt role s1 s2 h field_0 field_1 FIELD__2".split()


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def corpus(spark, n=60):
    rng, line = random.Random(5), "this is one line that ever so many documents hold"
    rows = [(i, f"{words(rng, 60)}\n{line}\n{words(rng, 10)}", "en", "abc"[i % 3], 1) for i in range(n)]
    rows += [(n + i, rows[0][1], "en", None, None) for i in range(3)]
    rows += [(None, words(rng, 30), None, "a", 5), (7, "another text of the seventh", "de", "b", 5), (7, rows[7][1], "en", "b", 1), (900, None, None, None, None), (901, "", "en", "d", 0), (902, words(rng, 20_000, 90_000), "en", "a", 9)]
    return spark.createDataFrame(rows, DOCS)


def clashing(docs):
    """``docs`` with a column of each working name that isn't its own."""
    return docs.select("*", *(F.lit(f"own {c}").alias(c) for c in INNER if c not in docs.columns))


STAGES = {
    "classifier": lambda docs: cotraining.score(docs, cotraining.CoTrained()),
    "lines": line_dedup.dedup_lines,
    "join": jaccard.keep_one,
    "mixing": mixing.mix,
}


@pytest.mark.parametrize("name", list(STAGES))
def test_no_name_clashes(spark, name):
    docs = corpus(spark)
    plain, mixed = STAGES[name](docs), STAGES[name](clashing(docs))
    new = [c for c in plain.columns if c not in docs.columns]
    assert sorted(mixed.columns) == sorted({*clashing(docs).columns, *new})
    key = lambda df: Counter(tuple(r) for r in df.select(*docs.columns, *new).collect())
    assert key(plain) == key(mixed)
    row = mixed.select(*(f"`{c}`" for c in INNER if c not in new and c not in docs.columns)).first()
    assert all(v == f"own {c}" for c, v in row.asDict().items())


def test_repeated_copies_keep_their_columns(spark):
    docs = clashing(corpus(spark)).drop("mix_copies", "mix_size")
    assert mixing.repeat_copies(mixing.mix(docs), docs.columns).columns == docs.columns


def labelled(spark, n=600):
    rng, rows, marks = random.Random(6), [], []
    for i in range(n):
        good = rng.random() < 0.7
        text = words(rng, 60) if good else " ".join(rng.choice("$$$ *** BUY!! NOW!!".split()) for _ in range(60))
        rows.append((i, text, "en", "clean" if good == (rng.random() < 0.9) else "junk", len(text)))
        if i < 300:
            marks.append((i, int(good), 0))
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(marks, "doc_id long, quality int, toxic int"), {r[0]: "$" not in r[1] and "!" not in r[1] for r in rows}


def test_classifier_on_held_out_rows(spark):
    docs, labels, truth = labelled(spark)
    model = cotraining.fit(docs, labels)
    assert 0 < len(model.exchanged) <= 3 and min(model.weights) >= 0 and min(p.slope for p in model.platts) >= 0
    got = {r.doc_id: r.cotrain_kept for r in cotraining.score(docs, model).collect()}
    assert np.mean([got[i] == truth[i] for i in range(300, 600)]) > 0.95
    again = cotraining.score(docs.repartition(5), cotraining.fit(docs.repartition(7), labels))
    assert {r.doc_id: r.cotrain_kept for r in again.collect()} == got


def test_classifier_of_odd_rows_and_few_labels(spark):
    docs, labels, _ = labelled(spark)
    model = cotraining.fit(docs.unionByName(docs.filter("doc_id < 50")), labels.unionByName(labels.limit(20).withColumn("quality", F.lit(None).cast("int"))))
    odd = corpus(spark)
    rows = cotraining.score(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r.cotrain_score <= 1 for r in rows)
    few = cotraining.score(docs, cotraining.fit(docs, labels.filter("doc_id < 20")))
    assert few.filter("cotrain_state = 'shrunk' AND cotrain_score BETWEEN 0 AND 1").count() == docs.count()
    one_class = cotraining.score(docs, cotraining.fit(docs, labels.filter("quality = 1")))
    assert one_class.filter("cotrain_state = 'unfitted' AND cotrain_kept AND cotrain_score = 1").count() == docs.count()


def measured(folder, rounds, parity):
    """Accuracy and AUC on the labelled documents of the other parity."""
    sql = f"SELECT d.doc_id, text, source, lang, n_chars, quality FROM '{folder}/documents.parquet' d LEFT JOIN (SELECT doc_id, min(quality) AS quality FROM '{folder}/labels.parquet' GROUP BY 1) USING (doc_id) ORDER BY 1"
    rows = duckdb.sql(sql).fetchall()
    text = cotraining.unpack_texts([cotraining.pack_text(r[1]) for r in rows])
    meta = np.stack([cotraining.meta_view(*r[2:5]) for r in rows])
    ids, quality = np.array([r[0] for r in rows]), np.array([-1 if r[5] is None else r[5] for r in rows])
    known = (quality >= 0) & (ids % 2 == parity)
    test = (quality >= 0) & ~known
    out = []
    for n in rounds:
        model = cotraining.co_train(text[known], meta[known], quality[known].astype(float), text[~known], meta[~known], rounds=n)
        score, y = model.score(text[test], meta[test]), quality[test]
        higher = (score[y == 1][:, None] > score[y == 0][None, :]).mean() + (score[y == 1][:, None] == score[y == 0][None, :]).mean() / 2
        out.append((((score >= 0.5) == (y == 1)).mean(), higher))
    return out


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
@pytest.mark.parametrize("parity", [0, 1])
def test_rounds_do_no_harm_on_the_tables(sf, parity):
    (accuracy, auc), (after, auc_after) = measured(f"/root/testdata/{sf}", (0, 3), parity)
    assert after >= accuracy and auc_after >= auc
    assert after > 0.96 and auc_after > 0.99


def test_exchange_helps_with_few_labels():
    """Two views that know the truth independently of each other, and forty labels in sixty dimensions."""
    gained = []
    for seed in range(6):
        rng = np.random.default_rng(seed)
        y = (rng.random(3000) < 0.6).astype(float)
        views = [np.concatenate([(2 * y[:, None] - 1) * 1.1 + rng.normal(size=(3000, 4)), rng.normal(size=(3000, 60))], axis=1).astype(np.float32) for _ in range(2)]
        right = []
        for rounds in (0, 3):
            model = cotraining.co_train(views[0][:40], views[1][:40], y[:40], views[0][40:2000], views[1][40:2000], rounds=rounds)
            right.append(((model.score(views[0][2000:], views[1][2000:]) >= 0.5) == (y[2000:] > 0.5)).mean())
        gained.append(right[1] - right[0])
    assert np.mean(gained) > 0.005


def test_language_model_against_plain_cosines(spark):
    rng = random.Random(4)
    kinds = {"en": ["the", "and", "with", "this"], "de": ["der", "und", "mit", "nicht"]}
    rows = [(i, " ".join(rng.choice(kinds[k]) for _ in range(30)), k) for i in range(120) for k in [list(kinds)[i % 2]]]
    odd = [(200, None, "en"), (201, "x", None), (202, "", "de"), (7, rows[7][1], "de"), (203, "123", "de")]
    df = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string")
    model = language_id.fit(df)
    texts = [t for _, t, _ in rows]
    x = language_id._vectors([language_id._counts(t) for t in texts], model.idf)
    cos = np.array([[float(np.dot(a, c)) for c in model.centroids] for a in x])
    got = model.predict(texts)
    assert [g[0] for g in got] == [model.langs[j] for j in cos.argmax(axis=1)]
    assert np.allclose([g[1] for g in got], cos.max(axis=1), atol=1e-5) and sum(g[2] for g in got) <= 2
    assert model.predict(["zzyzx qqq vvkk jjxx"])[0][2] and model.predict([None, "", "9"]) == [("und", 0.0, True)] * 3
    out = language_id.predict(df, model).collect()
    assert len(out) == 125 and all(0 <= r.score <= 1 for r in out)
    none = language_id.fit(df.filter("lang = 'xx'"))
    assert {r.lang_pred for r in language_id.predict(df, none).collect()} == {"und"}
    assert language_id.predict(df.limit(0), model).count() == 0


def test_packing_of_nulls_and_repeats(spark):
    docs = corpus(spark)
    rows = packing.pack(docs).collect()
    assert sum(r.start == 0 for r in rows) == docs.count()
    held = Counter()
    for r in rows:
        held[r.sequence_id] += r.length
    assert max(held.values()) <= 1024
    assert sum(r.length for r in rows) == sum(r.doc_tokens for r in rows if r.start == 0)


def test_packing_shares_fill_their_bins(spark):
    docs = spark.createDataFrame([(i, "one two three", "en", "a", 1) for i in range(3000)], DOCS).repartition(300)
    rows = packing.pack(docs).collect()
    sizes = Counter(r.sequence_id for r in rows)
    assert len(rows) == 3000 and len(sizes) <= 3000 // 64 + 4


def test_frame_checksum_and_long_documents(tmp_path):
    path = tmp_path / "x"
    with path.open("wb") as f:
        w = token_files.TokenFileWriter(f, frame_ids=100)
        for i in range(3):
            w.add(None if i == 0 else i, array("I", range(250)).tobytes())
        w.close()
    with path.open("rb") as f:
        reader = token_files.TokenFileReader(f)
        assert reader.ids(1) == array("I", range(250)).tobytes() and reader.frames_read <= 4
    raw = bytearray(path.read_bytes())
    n = struct.unpack("<I", raw[-9:-5])[0]
    raw[len(raw) - 9 - 12 * n + 8] ^= 1  # the first frame's checksum
    path.write_bytes(raw)
    with path.open("rb") as f, pytest.raises(ValueError, match="checksum"):
        token_files.TokenFileReader(f).ids(0)


def test_mixing_of_many_sources(spark):
    rng = random.Random(9)
    rows = [(i, words(rng, rng.randrange(1, 80)), "en", [None, "a", "b", "c", "d", "e"][i % 6], 1) for i in range(600)] + [(1000 + i, "", "en", "empty", 0) for i in range(3)]
    got = mixing.mix(spark.createDataFrame(rows, DOCS)).collect()
    size, target, taken = Counter(), {}, Counter()
    for r in got:
        size[r.source] += r.mix_size
        taken[r.source] += r.mix_taken
        target[r.source] = r.mix_target
        assert r.mix_taken <= 3 * r.mix_size and r.mix_source_size is not None
    assert target["empty"] == 0 and abs(sum(target.values()) - sum(size.values())) < 1e-6
    assert all(abs(taken[s] - target[s]) <= 80 and target[s] <= 3 * size[s] + 1e-9 for s in target)


def test_long_lists_give_the_same_links(spark):
    rng = random.Random(10)
    rows = []
    for g in range(12):
        base = words(rng, 60).split()
        for i in range(6):
            other = list(base)
            other[rng.randrange(60)] = f"x{g}{i}"
            rows.append(" ".join(other) + " and so on and on it goes")
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(rows)], DOCS)
    like = jaccard.Likeness(k=1, num=7, den=10)
    got = [{(r.doc_id, r.component_id) for r in jaccard.jaccard_groups(docs, like, long_list=n).collect()} for n in (1, 10_000)]
    sets = [set(t.split()) for t in rows]
    low = list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if 10 * len(a & b) >= 7 * len(a | b):
                    low[i] = low[j] = min(low[i], low[j])
    assert got[0] == got[1] == set(enumerate(low))


def test_long_lists_keep_links_of_sets_of_one_block(spark, monkeypatch):
    """Pairs of unlike sizes in one block, whichever of the two has the smaller component; only the index level links them."""
    monkeypatch.setattr(jaccard, "_stars", lambda nodes, *_: nodes.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0))
    texts = [" ".join(f"p{g}w{i}" for i in range(60 - less)) for g in range(40) for less in (0, 1)]
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(texts)], DOCS)
    for n in (1, 10_000):
        got = {(r.doc_id, r.component_id) for r in jaccard.jaccard_groups(docs, jaccard.Likeness(k=1), long_list=n).collect()}
        assert got == {(i, i - i % 2) for i in range(len(texts))}


def test_signatures_tell_large_sets_apart(spark):
    """Unlike sets of thousands of shingles are ruled out before their texts move; links across signatures of two lengths stay."""
    rng = np.random.default_rng(11)
    base = np.unique(rng.integers(0, 2**63, 1030, dtype=np.uint64))
    sets = [np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)) for n in (8000, 8100)] + [base, base[10:]]
    plain = lambda x: None if x is None else x.tolist()
    rows = [(i, len(x), plain(jaccard.parity(x, jaccard.SIGNATURE)), plain(jaccard._fine(x))) for i, x in enumerate(sets)]
    nodes = spark.createDataFrame(rows, "node long, n long, sig array<long>, fine array<long>")
    pairs = spark.createDataFrame([(0, 1), (3, 2)], "a long, b long")
    got = jaccard._by_signature(pairs, nodes, jaccard.Likeness(), 1 << 20).collect()
    assert [tuple(r) for r in got] == [(3, 2)] and rows[2][3] is not None and rows[3][3] is None


def test_one_row_of_repeated_ids(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (1, "g h i j k l"), (2, "a b c d e f"), (3, ""), (3, ""), (None, "a b c d e f")], "doc_id long, text string")
    kept = Counter((r.doc_id) for r in jaccard.keep_one(docs).collect())
    assert kept == {1: 1, 3: 2, None: 1}


def test_rules_behave_alike_at_every_length():
    for n in (60, 3000):
        assert quality_rules.RULES["stutter"](quality_rules.Page("a " * n)) and not quality_rules.RULES["stutter"](quality_rules.Page("a b c d " * n))


@pytest.mark.skipif(not Path(DATA).is_dir(), reason="no driver tables")
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    df = queries.QUERIES[name](spark, DATA)
    found = con.sql(queries.SQL[name])
    cols = [c for c in df.columns if c in found.columns]
    plain = lambda rows: sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows)
    assert plain(tuple(r[c] for c in cols) for r in df.collect()) == plain(found.select(*cols).fetchall())


@pytest.mark.parametrize("kind", ["odd", "empty"])
def test_pipeline(spark, tmp_path, kind):
    docs = corpus(spark, 120) if kind == "odd" else corpus(spark).limit(0)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    marks = spark.createDataFrame([(i, 1, 0) for i in range(5)], "doc_id long, quality int, toxic int")
    marks.write.parquet(f"{tmp_path}/labels.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "n-gram Jaccard join", "mixing", "packing"]
    kept = docs
    for name, stage in corpus_pipeline.STAGES:
        before, kept = kept, stage(spark, kept, str(tmp_path)).cache()
        assert name == "packing" or kept.columns == before.columns
        if name == "n-gram Jaccard join" and kind == "odd":
            ids = Counter(r.doc_id for r in kept.collect())
            # 122 alone kept the common line, so it is no near copy of the others any more
            assert not {120, 121} & set(ids) and ids[0] == 1 and ids[7] == 1 and ids[122] == 1
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32) for r in rows) == Counter((r.doc_id, r.start, r.length, r.ids_crc32) for r in kept.collect())
    assert bool(rows) == (kind == "odd")
