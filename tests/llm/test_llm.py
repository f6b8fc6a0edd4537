"""Training-data operators against brute force and on odd inputs."""

import random
import re
import zlib
from array import array
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import cotraining, jaccard, language_id, line_dedup, mixing, packing, quality_rules, suffixes, token_files, topk
from tidemark.llm.common import scratch_path
from tidemark.llm.components import components
from tidemark.llm.tokens import PieceEncoder, default_tokenizer

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    """Copies, near copies, shared passages, nulls, an empty and a long text."""
    rng = random.Random(3)
    texts = [words(rng, rng.randrange(20, 200)) for _ in range(40)]
    passage, line = words(rng, 60, 10_000), "a line that many documents hold, again and again"
    texts += [texts[0]] * 4 + [texts[1] + " more"] + [f"{words(rng, 30)} {passage} {words(rng, 30)}" for _ in range(6)]
    texts += [f"{words(rng, 60)}\n  {line.upper()} \n{words(rng, 5)}" for _ in range(7)]
    texts += [None, "", " \n\t ", "one", "two words", words(rng, 6000), "é " * 80]
    rows = [(i, t, "en" if i % 3 else None, [None, "a", "b", "c"][i % 4], len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def rows(docs):
    return {r.doc_id: r.text for r in docs.collect()}


def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_pieces_encode_as_whole_texts():
    enc, rng = PieceEncoder(default_tokenizer()), random.Random(1)
    alphabet = list("ab c  \n\n\t'sé1.,!\xa0 \x1c\0<|endoftext|>")
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(3000)]
    plain = Tokenizer.from_file(default_tokenizer())
    plain.encode_special_tokens = True
    assert enc.encode(texts) == [array("I", plain.encode(t, add_special_tokens=False).ids).tobytes() for t in texts]


def test_token_files_round_trip(spark, docs, rows):
    enc = PieceEncoder(default_tokenizer())
    folder = scratch_path(spark, "test-files")
    manifest = token_files.write_token_files(docs, folder, frame_ids=100)
    manifest = spark.createDataFrame(manifest.collect(), manifest.schema)
    got = {r.doc_id: r for r in token_files.token_digests(manifest).collect()}
    start = 0
    for doc_id in sorted(rows):
        ids = enc.encode([rows[doc_id]])[0] + array("I", [0]).tobytes()
        assert (got[doc_id].start, got[doc_id].n_tokens, got[doc_id].ids_crc32) == (start, len(ids) // 4, zlib.crc32(ids))
        start += len(ids) // 4
    path = manifest.first().path
    with open(path.removeprefix("file://"), "rb") as f:
        reader = token_files.TokenFileReader(f)
        reader.ids(0)
        assert reader.frames_read <= 2 + reader.index["count"][0] // 100


def test_damaged_frame_is_found(tmp_path):
    path = tmp_path / "x"
    with path.open("wb") as f:
        w = token_files.TokenFileWriter(f)
        w.add(1, array("I", range(500)).tobytes())
        w.close()
    raw = bytearray(path.read_bytes())
    raw[40] ^= 255
    path.write_bytes(raw)
    with path.open("rb") as f, pytest.raises(Exception):
        token_files.TokenFileReader(f).ids(0)


def test_packing_covers_every_id_once(docs, rows):
    enc = PieceEncoder(default_tokenizer())
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in packing.pack(docs).collect():
        pieces[r.doc_id].append(r)
        bins[r.sequence_id].append(r)
    for doc_id, text in rows.items():
        ids = enc.encode([text])[0] + array("I", [0]).tobytes()
        at = 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) // 4
            assert r.ids_crc32 == zlib.crc32(ids[4 * at : 4 * (at + r.length)])
            at += r.length
        assert at == len(ids) // 4
    for group in bins.values():
        at = 0
        for r in sorted(group, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024


def test_cut_lengths_waste_little():
    for n in range(1, 5000):
        cut = packing.cut_lengths(n)
        assert sum(length for _, length in cut) == n and all(length <= 1024 // j for j, length in cut)


def test_line_dedup_keeps_the_largest_doc(docs, rows):
    got = {r.doc_id: r for r in line_dedup.dedup_lines(docs, batches=3).collect()}
    key = lambda x: re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", x).translate({i: i + 32 for i in range(65, 91)})
    held = defaultdict(set)
    for doc_id, text in rows.items():
        for line in (text or "").split("\n"):
            if len(key(line)) >= 40:
                held[key(line)].add(doc_id)
    for doc_id, text in rows.items():
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (len(held.get(key(x), ())) >= 5 and doc_id != max(held[key(x)]))]
        assert (got[doc_id].n_lines, got[doc_id].n_dropped, got[doc_id].text) == (len(lines), len(lines) - len(kept), "\n".join(kept))


def test_mixing_comes_near_its_targets(docs):
    got = mixing.mix(docs).collect()
    taken, target, largest = defaultdict(int), {}, defaultdict(int)
    for r in got:
        taken[r.source] += r.mix_taken
        target[r.source] = r.mix_target
        largest[r.source] = max(largest[r.source], r.mix_size)
        assert 0 <= r.mix_taken <= 3 * r.mix_size
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in target)
    again = {(r.doc_id, r.mix_taken) for r in mixing.mix(docs.repartition(5)).collect()}
    assert again == {(r.doc_id, r.mix_taken) for r in got}


def test_jaccard_groups_equal_brute_force(docs, rows):
    sets = {}
    for doc_id, text in rows.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        sets[doc_id] = {tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else ({tuple(w)} if w else set())
    low = {d: d for d in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b]) and low[a] != low[b]:
                    low[a] = low[b] = min(low[a], low[b])
                    changed = True
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_groups(docs).collect()}
    assert got == {d: (len(s), low[d]) for d, s in sets.items()}


def test_repeated_passages_equal_brute_force(docs, rows):
    seen, n = defaultdict(set), 50
    split = {d: (t or "").encode().split() for d, t in rows.items()}
    for d, w in split.items():
        for i in range(len(w) - n + 1):
            seen[tuple(w[i : i + n])].add(d)
    expected = defaultdict(set)
    for d, w in split.items():
        for i in range(len(w) - n + 1):
            if len(seen[tuple(w[i : i + n])]) > 1:
                expected[d].update(range(i, i + n))
    got = defaultdict(set)
    for r in suffixes.repeated_passages(docs).collect():
        got[r.doc_id].update(range(r.start_word, r.end_word))
    assert got == expected


def variants(spark):
    """Two documents hold a passage of 15 + 35 words; each has neighbours that share more on the right, but not the left.

    No suffix is retained in the left part of the first, so only the one between the parts can find it.
    """
    rng, how = random.Random(11), suffixes.Passages()
    while True:
        left, right, first = words(rng, 15, 10_000), words(rng, 35, 10_000), words(rng, 30, 10_000)
        raw = np.frombuffer(f"{first} {left} {right}".encode(), dtype=np.uint8)
        if not any(30 <= p < 45 for p in suffixes.retained(suffixes.word_hashes(raw, np.array([0, len(raw)]))[0], how)):
            break
    rows = []
    for _ in range(2):
        more = words(rng, 5, 10_000)
        rows += [f"{words(rng, 30, 10_000) if rows else first} {words(rng, 15, 10_000) if i else left} {right} {more} {words(rng, 30, 10_000)}" for i in range(13)]
    return spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(rows)], DOCS)


def passages(docs, n=50):
    """(words of each document in repeated passages by brute force, by the operator)."""
    seen, expected, got = defaultdict(set), defaultdict(set), defaultdict(set)
    split = {r.doc_id: r.text.split() for r in docs.collect()}
    for d, w in split.items():
        for i in range(len(w) - n + 1):
            seen[tuple(w[i : i + n])].add(d)
    for d, w in split.items():
        for i in range(len(w) - n + 1):
            if len(seen[tuple(w[i : i + n])]) > 1:
                expected[d].update(range(i, i + n))
    for r in suffixes.repeated_passages(docs).collect():
        got[r.doc_id].update(range(r.start_word, r.end_word))
    return expected, got


def test_passage_whose_partner_is_not_the_nearest(spark):
    expected, got = passages(variants(spark))
    assert expected and got == expected


def test_self_repeats_across_partitions(spark):
    rng, n = random.Random(12), spark.conf.get("spark.sql.shuffle.partitions")
    passage = words(rng, 60, 10_000)
    texts = [" ".join(f"{passage} {words(rng, 20, 10_000)}" for _ in range(40)), f"{words(rng, 30, 10_000)} {passage}"]
    df = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(texts)], DOCS)
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    try:
        expected, got = passages(df)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", n)
    assert len(expected) == 2 and got == expected


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    assert {(r.id, r.component) for r in components(links).collect()} == {(i, 0) for i in range(41)} | {(100, 100), (101, 100)}


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=(300, 8)) + 5 * rng.normal(size=8) for _ in range(4)])
    x[10:60] = x[9]
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x.astype(np.float32))] + [(5000, None), (5050, [float("nan")] * 8)]
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), block_rows=500).collect()}
    whole = np.floor(256 * x.astype(np.float32).astype(float)).astype(np.int64)
    for q in range(0, 1200, 50):
        s = whole @ whole[q]
        best = [i for i in sorted(range(1200), key=lambda i: (-s[i], i)) if i != q][:5]
        assert [got[q, k + 1] for k in range(5)] == [(i, s[i]) for i in best]
    assert len(got) == 24 * 5


def test_dual_tree_prunes():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(200, 6)) + 400 * np.eye(6)[j] for j in range(6)]).round()
    tree = topk.DualTree(x.astype(np.int64), np.arange(1200), 3).add(x.astype(np.int64), np.arange(1200))
    assert tree.compared < 1200 * 1200 / 4  # six far clusters: a sixth at best


def test_dual_tree_prunes_over_blocks_in_many_dimensions():
    """Kth scores of earlier blocks prune later ones; 64 dimensions, twenty clusters."""
    rng = np.random.default_rng(8)
    centres = 600 * rng.normal(size=(20, 64))
    x = np.concatenate([c + rng.normal(size=(400, 64)) for c in centres]).round().astype(np.int64)
    x = x[rng.permutation(len(x))]
    tree = topk.DualTree(x[::50], np.arange(len(x))[::50], 5)
    for lo in range(0, len(x), 2000):
        tree.add(x[lo : lo + 2000], np.arange(lo, min(lo + 2000, len(x))))
    assert tree.compared < len(x) * len(x[::50]) / 3
    whole = x[::50] @ x.T
    for i, row in enumerate(whole):
        best = [j for j in np.lexsort((np.arange(len(x)), -row)) if j != 50 * i][:5]
        assert tree.best_id[i].tolist() == best and tree.best[i].tolist() == row[best].tolist()


@pytest.mark.parametrize("power", [20, 28, 31, 70])
def test_scores_are_exact_integers(spark, power):
    """Products beyond 2^53 and 2^62 against Python's integers; beyond a long they count as its ends."""
    rng = random.Random(power)
    rows = [(i, [float(rng.randrange(-(2 ** min(power, 52)), 2 ** min(power, 52)) * 2 ** max(0, power - 52)) for _ in range(rng.choice([3, 3, 2]))]) for i in range(120)]
    rows += [(50, [1.0]), (7, None), (8, [None, 1.0]), (9, []), (None, [1.0])]
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=10, chunk_queries=4, block_rows=16).collect()}
    data = [(i, [256 * int(v) for v in e]) for i, e in rows if i is not None and e is not None and None not in e]
    queries = {}
    for i, e in rows:
        if i is not None and i % 10 == 0 and e is not None:
            queries[i] = min(queries.get(i, e), e)
    clip = lambda s: max(min(s, 2**63 - 1), -(2**63) + 1)
    for q, e in queries.items():
        scores = sorted((-clip(sum(256 * int(a) * b for a, b in zip(e, d))), i) for i, d in data if i != q)[:5]
        assert [got[q, k + 1] for k in range(5)] == [(i, -s) for s, i in scores]
    assert len(got) == 5 * len(queries)


def test_rules_stop_at_the_first(docs):
    calls = []
    rules = {"never": lambda p: calls.append("never") and False, "always": lambda p: True}
    cascade = quality_rules.Cascade(["always", "never"])
    assert cascade.rejects(quality_rules.Page("x " * 60), rules) == "always" and not calls


def test_repeat_words_count_covered_positions():
    p = quality_rules.Page("a b c a b c d")
    assert p.n_repeat_words == 6
    assert quality_rules.Page("a a a a").n_repeat_words == 4


def test_languages_on_held_out_rows(spark):
    rng = random.Random(4)
    kinds = {"en": ["the", "and", "with", "this"], "de": ["der", "und", "mit", "nicht"], "fr": ["les", "avec", "dans", "été"]}
    rows = [(i, " ".join(rng.choice(kinds[k]) for _ in range(30)), k) for i in range(150) for k in [list(kinds)[i % 3]]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(df.filter("doc_id < 100"))
    got = {r.doc_id: r.lang_pred for r in language_id.predict(df, model).collect()}
    assert all(got[i] == k for i, _, k in rows if i >= 100)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !")], "doc_id long, text string")
    assert {(r.lang_pred, r.score) for r in language_id.predict(odd, model).collect()} == {("und", 0.0)}


def test_co_training_exchanges_and_separates():
    rng = np.random.default_rng(5)
    y = (rng.random(600) < 0.7).astype(float)
    text = np.stack([y * 3 + rng.normal(size=600), rng.normal(size=600)], axis=1)
    meta = np.stack([y * 3 + rng.normal(size=600), rng.normal(size=600)], axis=1)
    model = cotraining.co_train(text[:200], meta[:200], y[:200], text[200:], meta[200:], sure=0.9)
    right = ((model.score(text, meta) >= 0.5) == (y > 0.5)).mean()
    assert right > 0.93 and sum(model.exchanged) > 0


def test_empty_tables_and_clashing_columns(spark):
    none = empty(spark)
    assert packing.pack(none).count() == 0
    assert line_dedup.dedup_lines(none).count() == 0
    assert mixing.mix(none).count() == 0
    assert jaccard.jaccard_groups(none).count() == 0
    assert suffixes.repeated_passages(none).count() == 0
    assert quality_rules.judge(none).count() == 0
    assert token_files.encode_and_digest(none).count() == 0
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert cotraining.score(none, cotraining.fit(none, labels)).count() == 0
    one = spark.createDataFrame([(1, 'x', 'en', 'a', 1)], DOCS)
    assert [r.cotrain_state for r in cotraining.score(one, cotraining.fit(one, labels)).collect()] == ['unfitted']
    clash = spark.createDataFrame([(1, "x " * 70, "en", "a", 3, 1, 2, 3)], f"{DOCS}, n_lines long, size long, component long")
    assert line_dedup.dedup_lines(clash).count() == 1 and mixing.mix(clash).count() == 1
    assert jaccard.keep_one(clash).columns == clash.columns


def test_null_and_repeated_ids(spark):
    rows = [(None, "same text here now", "en", "a", 1)] * 3 + [(7, "same text here now", "en", "a", 1)] * 2 + [(7, "other words stand here", "en", None, 1)]
    df = spark.createDataFrame(rows, DOCS)
    for out in (mixing.mix(df), jaccard.jaccard_groups(df), line_dedup.dedup_lines(df), quality_rules.judge(df), token_files.encode_and_digest(df)):
        assert out.count() == 6
    assert suffixes.repeated_passages(df).count() == 0


def test_pipeline_drops_near_copies(spark, docs):
    kept = jaccard.keep_one(docs, jaccard.Likeness(k=5, num=8, den=10))
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert 0 in ids and not ids & {40, 41, 42, 43}
    assert kept.columns == docs.columns
    mixed = mixing.repeat_copies(mixing.mix(kept), kept.columns)
    assert mixed.columns == docs.columns and mixed.filter(F.col("doc_id").isNull()).count() == 0
