"""Every operator on awkward rows, on no rows, and against a plain version on a whole small table."""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from claimscope.llm import packing, queries
from claimscope.llm.common import components, running_totals, table
from claimscope.llm.exact_dedup import exact_dedup
from claimscope.llm.line_dedup import CuckooFilter, LineIndex, dedup_lines
from claimscope.llm.mixing import mix, source_targets
from claimscope.llm.near_dedup import near_dedup
from claimscope.llm.packing import bins_needed, pack
from claimscope.llm.secrets import secret_scan
from claimscope.llm.sharding import hilbert_shards, write_shards
from claimscope.llm.topk import top_k
from claimscope.llm.toxicity import learn, score_toxicity


def rows_of(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def texts_of(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


# near dedup
@pytest.mark.parametrize("block", [1024, 2])
def test_near_dedup_on_odd_rows(odd, block):
    got = near_dedup(odd, shingle=2, block=block)
    assert rows_of(got, "doc_id", "n_shingles", "component_id", "kept") == brute.near(texts_of(odd), 2)


def test_near_dedup_on_a_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    assert rows_of(queries.op1_minhash_near_dedup(spark, sf_dir), "doc_id", "n_shingles", "component_id", "kept") == brute.near(texts_of(docs), 2)
    assert rows_of(near_dedup(docs), "doc_id", "n_shingles", "component_id", "kept") == brute.near(texts_of(docs), 5)


def test_near_dedup_of_a_chain(spark):
    """Each text is linked with its neighbours only; the group is one, and blocks that split it lose nothing."""
    words = [f"w{i}" for i in range(140)]
    docs = [(100 - i, " ".join(words[4 * i:4 * i + 60])) for i in range(20)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute.near(docs, 2)
    assert len({r[2] for r in want}) == 1
    assert rows_of(near_dedup(df, shingle=2, block=3), "doc_id", "n_shingles", "component_id", "kept") == want


def test_near_dedup_of_nothing(none):
    assert near_dedup(none).count() == 0


def test_components_of_a_long_path(spark):
    edges = spark.range(302).select((F.col("id") * 7 % 303).alias("a"), ((F.col("id") + 1) * 7 % 303).alias("b"))
    found = {r["node"]: r["component"] for r in components(edges).collect()}
    assert len(found) == 303 and set(found.values()) == {0}


# exact dedup
def test_exact_dedup_on_odd_rows(odd):
    got = rows_of(exact_dedup(odd, salts=2), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    groups: dict[str, list] = {}
    for i, t in texts_of(odd):
        groups.setdefault(t or "", []).append(i)
    want = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        want += [(i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    assert got == sorted(want, key=repr)


def test_exact_dedup_compares_texts_where_digests_collide(odd):
    names = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert rows_of(exact_dedup(odd, digest=lambda t: F.length(t).cast("string")), *names) == rows_of(exact_dedup(odd), *names)


def test_exact_dedup_of_nothing(none):
    assert exact_dedup(none).count() == 0


# secrets
def test_secret_scan_on_odd_rows(odd):
    got = rows_of(secret_scan(odd), "doc_id", "n_assign", "n_access", "n_hex", "base_sha256")
    assert got == sorted(((i, *brute.secrets(t)) for i, t in texts_of(odd)), key=repr)


def test_secret_scan_on_a_table(spark, sf_dir):
    got = rows_of(queries.op3_secret_scan(spark, sf_dir), "doc_id", "n_assign", "n_access", "n_hex", "base_sha256")
    assert got == sorted(((i, *brute.secrets(t)) for i, t in texts_of(table(spark, sf_dir, "documents"))), key=repr)


def test_owners_tell_copied_from_live(spark):
    shared, own = "Zx81Kd93Lq02Mv57Pw46", "Ty72Hg15Bn88Cw33Rf60"
    docs = spark.createDataFrame(
        [(i, f"see {shared} here", "en", f"s{i}") for i in range(4)] + [(9, f"x {own} {own}, password=short token=abcdefghijkl", "en", "s0")],
        "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r for r in secret_scan(docs).collect()}
    assert got[0]["spans"] == "" and got[0]["n_copied"] == 1 and got[0]["n_live"] == 0
    text = f"x {own} {own}, password=short token=abcdefghijkl"
    at = text.index("token=")
    assert got[9]["spans"] == f"token:2:22,token:23:43,assign:{at}:{len(text)}" and got[9]["n_live"] == 3


def test_one_owner_in_two_languages_is_live_and_two_owners_share(spark):
    own, two = "Zx81Kd93Lq02Mv57Pw46", "Ty72Hg15Bn88Cw33Rf60"
    docs = spark.createDataFrame([(1, own, "en", "a"), (2, own, "de", "a"), (3, two, "en", "a"), (4, two, "en", "b"), (5, two, "en", "b")],
                                 "doc_id long, text string, lang string, source string")
    got = rows_of(secret_scan(docs), "doc_id", "spans", "n_live", "n_shared", "n_copied", "n_repos")
    assert got == [(1, "token:0:20", 1, 0, 0, 2), (2, "token:0:20", 1, 0, 0, 2), (3, "", 0, 1, 0, 0), (4, "", 0, 1, 0, 0), (5, "", 0, 1, 0, 0)]


def test_ownership_over_a_whole_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    got = rows_of(secret_scan(docs), "doc_id", "spans", "n_live", "n_shared", "n_copied")
    assert got == brute.owned_secrets([tuple(r) for r in docs.select("doc_id", "text", "source").collect()])


def test_secret_scan_of_nothing(none):
    assert secret_scan(none).count() == 0


# top-k
def plain_top_k(rows, is_query, k, scale=256):
    """Every query row against every row of another id; of queries that share an id, the best of all."""
    good = [(i, [math.floor(scale * c) for c in v]) for i, v in rows
            if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    found: dict = {}
    for q, x in good:
        if is_query(q):
            found.setdefault(q, []).extend((-sum(a * b for a, b in zip(x, y, strict=False)), i) for i, y in good if i != q)
    return sorted(((q, n + 1, i, -s) for q, pairs in found.items() for n, (s, i) in enumerate(sorted(pairs)[:k])), key=repr)


@pytest.mark.parametrize("far", [1.0, 1e6, 1.7e6])  # scores in doubles, in 64-bit numbers, and in numbers of any size
def test_top_k_with_ties_repeated_ids_and_bad_rows(spark, far):
    rows = [(i, [far * (i % 3), far * 0.5 + i / 1024, -0.25]) for i in range(40)] + [
        (40, None), (41, [1.0, None, 0.0]), (42, [float("nan"), 0.0, 0.0]), (None, [1.0, 1.0, 1.0]), (43, [float("inf"), 0.0, 0.0]),
        (44, []), (45, [2.0]), (7, [far, 0.5, -0.25]), (7, [2 * far, 0.5, 0.25]), (7, [2 * far, 0.5, 0.25]), (20, [-far, 3.0, 1.0])]
    rows += [(60, [3 * far, far, 0.0])] * 9 + [(70, [3 * far, far, 0.0])] * 7  # queries with many rows of their own id
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x")).withColumn("x", F.lit(1))
    want = plain_top_k(rows, lambda i: i % 10 == 0, 5)
    for size, go in ((7, 2), (4096, 4096)):
        got = top_k(df, lambda i: i % 10 == 0, rows=size, queries=go)
        assert rows_of(got, "query_id", "rank", "vec_id", "score") == want


def test_top_k_finds_what_single_slices_rank_low(spark):
    """The best row is in no slice's own list; only the cutoff brings it to light."""
    rows = [(0, [1.0, 0.0, 1.0, 0.0])] + [(i, [5.0 + i / 100, 0.0, -4.0, 0.0]) for i in range(1, 20)] + [
        (i, [-4.0, 0.0, 5.0 + i / 100, 0.0]) for i in range(20, 40)] + [(99, [3.0, 9.0, 3.0, -9.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = top_k(df, lambda i: i == 0, k=2, rows=100)
    assert rows_of(got, "query_id", "rank", "vec_id", "score") == plain_top_k(rows, lambda i: i == 0, 2)
    assert got.first()["vec_id"] == 99


def test_top_k_with_too_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, -4.0])], "vec_id long, embedding array<double>")
    assert rows_of(top_k(df, lambda i: i % 50 == 0), "query_id", "rank", "vec_id", "score") == [(0, 1, 1, 256 * 256 * (3 - 8))]
    assert top_k(df.limit(0), lambda i: i % 50 == 0).count() == 0
    assert top_k(df, lambda i: i < 0).count() == 0


# toxicity
def test_toxicity_learns_and_scores(spark, odd, none):
    clean = [f"aa{i % 97} bb{i % 89} cc{i % 83} dd{i % 79} wonder" for i in range(300)]
    vile = [f"aa{i % 97} bb{i % 89} vermin{'' if i % 2 else 's'} you {['filthbag', 'scoundrel'][i % 3 > 0]} dd{i % 79}" for i in range(120)]
    docs = spark.createDataFrame(list(enumerate(clean + vile)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i >= 300)) for i in range(420)] + [(1, None), (None, 1), (9999, 1)], "doc_id long, toxic int")
    model = learn(docs, labels)
    assert "scoundrel" in model.words and any(s.startswith("vermin") for s in model.stems + model.words)
    cases = ["a scoundrel and a scoundrel", "a scoundrell, what a scoundrle scoundre", 'he wrote "scoundrel" there', "wonder aa1", "", None]
    scored = score_toxicity(spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string"), model).orderBy("doc_id").collect()
    assert [r["predicted"] for r in scored] == [1, 1, 0, 0, 0, 0]
    out = score_toxicity(odd, model)
    assert out.count() == odd.count() and all(0 <= r["score"] <= 1 for r in out.collect()) and out.schema["score"].dataType.simpleString() == "double"
    assert score_toxicity(none, learn(none, labels.limit(0))).count() == 0


def test_toxicity_on_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = queries.op5_toxicity(spark, sf_dir)
    want = table(spark, sf_dir, "labels").where("doc_id IS NOT NULL")
    assert got.count() == table(spark, sf_dir, "documents").count()
    assert got.where("score < 0 OR score > 1 OR predicted <> cast(score >= 0.5 as int)").count() == 0
    assert got.where("held_out <> (crc32(cast(doc_id as string)) % 5 = 0)").count() == 0
    marked = got.join(want, "doc_id").where("held_out")
    assert marked.where("predicted = toxic").count() / marked.count() > 0.95
    assert marked.where("predicted = 1 AND toxic = 0").count() == 0


# mixing
def test_targets_stop_at_the_cap(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 1000), ("c", 1000), (None, 0)], "source string, source_size long")
    got = {r["source"]: r["target"] for r in source_targets(sizes, 1.5, (5, 2, 1), 2.0).collect()}
    assert got["a"] == 200.0 and got[None] == 0.0
    assert got["b"] == pytest.approx(2 * 950) or got["b"] + got["c"] == pytest.approx(3150 - 200)
    assert got["b"] <= 2000 and got["c"] <= 2000 and sum(got.values()) == pytest.approx(3150)


def test_mix_on_odd_rows(odd, none):
    got = mix(odd).collect()
    assert len(got) == odd.count() and all(r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 2 for r in got)
    assert {r["doc_id"]: r["size"] for r in got}[12] == len(brute.WORD.findall("a b İ \U0001F600 token: aaaaaaaaaaaa"))
    assert sorted(map(repr, got)) == sorted(map(repr, mix(odd.repartition(3)).collect()))
    assert mix(none).count() == 0


def test_mix_comes_near_its_targets(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = mix(table(spark, sf_dir, "documents")).groupBy("source").agg(
        F.sum("taken").alias("taken"), F.max("target").alias("target"), F.min("size").alias("least")).collect()
    assert all(abs(r["taken"] - r["target"]) <= max(50, 0.02 * r["target"]) for r in rows)


# lines
def test_mix_meets_its_targets_without_ids(spark):
    rows = [(None if n % 3 else 7, "w " * 10 if n % 2 else f"t{n} " + "v " * (n % 9), s) for s in "abc" for n in range(300)]
    found = mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    for s in "abc":
        mine = [r for r in found if r["source"] == s]
        assert len(mine) == 300 and abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 5


def test_lines_on_odd_rows(odd, none):
    got = dedup_lines(odd)
    assert rows_of(got, "doc_id", "n_lines", "n_dropped", "text") == brute.lines(texts_of(odd))
    assert set(odd.columns) <= set(got.columns)
    assert dedup_lines(none).count() == 0


def test_lines_come_back_when_their_keeper_goes(spark):
    docs = spark.createDataFrame([(1, "a line that is shared\nown one"), (2, "A line that is SHARED \nanother"), (3, "a line that is shared")], "doc_id long, text string")
    index = LineIndex.of(docs.where("doc_id < 3")).insert(docs.where("doc_id = 3"))
    assert sorted(r["doc"] for r in index.surplus().collect()) == [2, 3]
    without = index.delete(docs.where("doc_id = 1"))
    assert sorted(r["doc"] for r in without.surplus().collect()) == [3]
    counts = lambda i: rows_of(i.reference_counts(), "k1", "k2", "refs", "keeper")
    assert counts(without.insert(docs.where("doc_id = 1"))) == counts(index)
    assert without.delete(docs.where("doc_id = 2")).surplus().count() == 0


def index_state(index):
    """Shared keys, surplus, and whether each shared key is in its filter and how many keys the filters hold."""
    shared = rows_of(index.shared(), "k1", "k2", "refs", "keeper")
    filters = {r["shard"]: CuckooFilter.from_bytes(r["filter"]) for r in index.filters().collect()}
    assert all(filters[k1 % index.shards()].has(np.array([k1])).all() for k1, *_ in shared)
    assert sum(int((f.slots > 0).sum()) for f in filters.values()) == len(shared)
    assert shared == rows_of(index.reference_counts().where("refs > 1"), "k1", "k2", "refs", "keeper")
    return shared, rows_of(index.surplus(), "doc", "row", "k1", "k2")


def test_line_index_changes_equal_a_new_index(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    late, gone = docs.where("doc_id % 100 = 3"), docs.where("doc_id % 100 = 0")
    whole = LineIndex.of(docs)
    grown = LineIndex.of(docs.where("doc_id % 100 <> 3")).insert(late)
    assert index_state(grown) == index_state(whole)
    less = grown.delete(gone)
    assert index_state(less) == index_state(LineIndex.of(docs.where("doc_id % 100 <> 0")))
    assert index_state(less.insert(gone)) == index_state(whole)
    assert index_state(less.fold()) == index_state(less)
    held = LineIndex.of(gone).reference_counts().count()
    assert less.changes.where(f"at = {less.at}").count() <= held  # what is written follows the change


def test_lines_of_many_rows_without_an_id(spark):
    docs = spark.createDataFrame([(1, "this line is shared by all")] + [(None, f"this line is shared by all\nand line {i} is its own") for i in range(400)],
                                 "doc_id long, text string")
    assert rows_of(dedup_lines(docs).where("doc_id IS NULL"), "text", "n_dropped") == sorted([(f"and line {i} is its own", 1) for i in range(400)], key=repr)
    per_row = LineIndex.of(docs).surplus().groupBy("doc", "row").count()
    assert per_row.agg(F.max("count")).first()[0] == 1 and per_row.count() == 400


def test_line_index_of_nothing(none, odd):
    index = LineIndex.of(none)
    assert index.surplus().count() == 0 and index.delete(odd).surplus().count() == 0
    assert index_state(index.insert(odd)) == index_state(LineIndex.of(odd))
    assert index_state(LineIndex.of(odd).delete(odd))[0] == []


# packing
def check_packing(rows, docs, encode):
    by_doc: dict = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    for doc, text in docs:
        ids = [*encode(text or ""), 0]
        pieces = sorted(by_doc[doc], key=lambda r: r["piece"])
        if sum(d == doc for d, _ in docs) > 1:
            continue
        assert [r["start"] for r in pieces] == [sum(p["length"] for p in pieces[:n]) for n in range(len(pieces))]
        assert sum(r["length"] for r in pieces) == len(ids) and all(r["length"] == 2048 for r in pieces[1:])
        assert all(r["ids_crc32"] == brute.crc(ids[r["start"]:r["start"] + r["length"]]) for r in pieces)
    sequences: dict = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    return len(sequences)


@pytest.fixture(scope="module")
def encode():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer_path())
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_packing_on_odd_rows(odd, none, encode):
    check_packing(pack(odd, queries.tokenizer_path()).collect(), texts_of(odd), encode)
    assert pack(none, queries.tokenizer_path()).count() == 0


def test_packing_exchanges_until_certified(spark, sf_dir, encode):
    docs = table(spark, sf_dir, "documents")
    one = pack(docs, queries.tokenizer_path()).collect()
    many = pack(docs, queries.tokenizer_path(), group=20).collect()
    used = check_packing(one, texts_of(docs), encode)
    assert used <= 1.02 * -(-sum(r["length"] for r in one) // 2048) + 1
    assert check_packing(many, texts_of(docs), encode) <= 1.1 * used  # groups far smaller than any in use


def test_only_groups_with_a_gap_exchange_until_nothing_is_saved(spark, sf_dir, monkeypatch):
    turns, real = [], packing._pack_round

    def watched(pieces, rows, turn, capacity, group):
        out = real(pieces, rows, turn, capacity, group)
        key = ["doc_id", "piece", "ids_crc32"]
        turns.append(({tuple(r) for r in pieces.select(key).collect()}, {tuple(r[:3]): (r[3], r[4], r[5]) for r in out.select(*key, "fill", "certain", "sequence_id").collect()}))
        return out

    monkeypatch.setattr(packing, "_pack_round", watched)
    pack(table(spark, sf_dir, "documents"), queries.tokenizer_path(), group=60)
    placed, kinds = dict(turns[0][1]), set()
    for moved, after in turns[1:]:
        gap = {k for k, (fill, certain, _) in placed.items() if fill < 2048 and not certain}
        every = {k for k, (fill, *_) in placed.items() if fill < 2048}
        assert moved in (gap, every)
        kinds.add(moved == gap)
        if len({placed[k][2] for k in moved}) > len({x[2] for x in after.values()}):
            placed |= after
    lengths = [r["length"] for r in pack(table(spark, sf_dir, "documents"), queries.tokenizer_path()).collect() if r["length"] < 2048]
    bound = bins_needed(np.bincount(lengths, minlength=2049))
    assert True in kinds and (False in kinds or len({x[2] for x in placed.values()}) == bound)


def test_packing_gives_added_tokens_their_id(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer_path())
    texts = ["a<|endoftext|>b", "<|endoftext|>", " one <|endoftext|>\n two  <|endoftext|><|endoftext|> three ", "no <|endoftext| >", "x<|endoftext|>" * 1500]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert t.encode(texts[0], add_special_tokens=False).ids == [64, 50256, 65]
    check_packing(pack(docs, queries.tokenizer_path()).collect(), texts_of(docs), lambda text: t.encode(text, add_special_tokens=False).ids)


# sharding
def test_shards_on_odd_rows(odd, none):
    rows = hilbert_shards(odd, 4).collect()
    assert len(rows) == odd.count()
    for s in range(4):
        slots = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert slots == list(range(len(slots)))
    texts = {i: t for i, t in texts_of(odd) if i is not None}
    assert all(r["size"] == len((texts[r["doc_id"]] or "").encode()) + 1 and r["text_crc32"] == zlib.crc32((texts[r["doc_id"]] or "").encode())
               for r in rows if r["doc_id"] is not None)
    assert hilbert_shards(none).count() == 0


def test_shards_hold_equal_bytes_and_whole_groups(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = table(spark, sf_dir, "documents")
    rows = queries.op10_sharding(spark, sf_dir).collect()
    sizes, slots = [0] * 16, [[] for _ in range(16)]
    for r in rows:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert max(sizes) < 1.1 * min(sizes) and all(sorted(s) == list(range(len(s))) for s in slots)
    texts, shards = dict(texts_of(docs)), {}
    for r in rows:
        shards.setdefault(texts[r["doc_id"]] or "", set()).add(r["shard"])
    assert all(len(s) == 1 for s in shards.values())


def test_shards_are_written_and_narrow(spark, sf_dir, tmp_path):
    docs = table(spark, sf_dir, "documents")
    write_shards(docs, hilbert_shards(docs, 4), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == docs.count() and sorted(p.name for p in (tmp_path / "out").glob("shard=*")) == [f"shard={i}" for i in range(4)]
    spread = back.groupBy("shard").agg(F.countDistinct("source").alias("n"), (F.max("doc_id") - F.min("doc_id")).alias("ids")).collect()
    assert sum(r["n"] for r in spread) < 4 * docs.select("source").distinct().count()


def test_running_totals(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 101).alias("k"), F.col("id"), (F.col("id") % 5).alias("g"))
    got = running_totals(df, ["g", "k", "id"], {"total": F.col("id")}, "test", within=["g"]).collect()
    want: dict = {}
    for r in sorted(got, key=lambda r: (r["g"], r["k"], r["id"])):
        assert r["total"] == want.get(r["g"], 0)
        want[r["g"]] = want.get(r["g"], 0) + r["id"]
