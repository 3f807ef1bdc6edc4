"""The stages of the corpus pipeline, one by one on awkward rows and in a row on a whole small table."""

from __future__ import annotations

import os
from collections import Counter

import brute
import corpus_pipeline as pipeline
from claimscope.llm import queries
from claimscope.llm.common import table
from claimscope.llm.mixing import mix
from claimscope.session import shared_root


def pairs(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def one_of_each(rows):
    """What five-word near dedup keeps: of each id that stays, the text that comes first."""
    stay = {r[0] for r in brute.near(rows, 5) if r[3]}
    return sorted({i: min((t or "", t) for j, t in rows if j == i)[1] if any(t is not None for j, t in rows if j == i) else None
                   for i, _ in rows if i in stay}.items(), key=repr)


def test_stages_keep_the_columns_and_treat_odd_rows(spark, odd, none, sf_dir):
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, odd, sf_dir)
        assert out.columns == odd.columns and [t for _, t in out.dtypes] == [t for _, t in odd.dtypes], name
        assert stage(spark, none, sf_dir).count() == 0
    assert pipeline.STAGES[-1][1](spark, none, sf_dir).count() == 0
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "mixing", "packing"]


def test_stages_on_odd_rows(spark, odd, sf_dir):
    assert pipeline.drop_toxic(spark, odd, sf_dir).count() == odd.count(), "nothing here is toxic"
    kept = pipeline.drop_lines(spark, odd, sf_dir)
    assert sorted(((r["doc_id"], r["text"], r["n_chars"]) for r in kept.collect()), key=repr) == sorted(
        ((i, t, len(t)) for i, t in brute.not_emptied(pairs(odd))), key=repr)
    single = pipeline.drop_near_copies(spark, odd.filter("doc_id IS NOT NULL"), sf_dir)
    assert sorted(((i, t) for i, t in pairs(single)), key=repr) == [(i, None if t is None else t) for i, t in one_of_each(pairs(odd.filter("doc_id IS NOT NULL")))]
    ids = odd.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    want = {r["doc_id"]: r["copies"] for r in mix(ids).collect() if r["copies"]}
    assert Counter(i for i, _ in pairs(pipeline.mix_sources(spark, ids, sf_dir))) == want


def test_documents_that_line_dedup_empties_leave(spark, sf_dir):
    lines = [f"a line that {n} documents share" for n in range(3)]
    rows = [(1, "\n".join(lines)), (2, "\n".join(lines[:2])), (3, lines[0] + "\nits own"), (4, ""), (5, None), (6, " \n "), (7, "short\n" + lines[1]), (8, lines[2].upper() + "\n  ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(pairs(pipeline.drop_lines(spark, docs, sf_dir))) == [(1, rows[0][1]), (3, "its own"), (4, ""), (5, ""), (6, " \n "), (7, "short")]


def kept_by_row(rows):
    """What five-word near dedup keeps where every row is a document; null ids come last."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    return sorted((rows[r[0]] for r in brute.near([(n, t) for n, (_, t) in enumerate(rows)], 5) if r[3]), key=repr)


def test_near_copies_go_row_by_row(spark, odd, sf_dir):
    assert sorted(pairs(pipeline.drop_near_copies(spark, odd, sf_dir)), key=repr) == kept_by_row(pairs(odd))
    copy, own = "a copy of the very first document of this table", "zebras hold a text that no other row of it has"
    rows = [(1, copy), (5, copy), (5, own), (5, own), (None, copy.upper()), (None, None)]
    rows += [(None, f"document {n} without an id has words{n} and more{n} of its{n} own{n}") for n in range(20)]
    docs = spark.createDataFrame([(*r, None) for r in rows], "doc_id long, text string, source string")
    found = sorted(pairs(pipeline.drop_near_copies(spark, docs, sf_dir)), key=repr)
    assert found == kept_by_row(rows) and len(found) == 23


def test_mixed_rows_follow_their_own_source(spark, sf_dir):
    docs = spark.createDataFrame([(None if n % 2 else 3, f"text {n} {'w ' * (n % 7)}", s) for s, k in (("a", 4), ("b", 40), ("c", 40)) for n in range(k)],
                                 "doc_id long, text string, source string")
    want = Counter()
    for r in mix(docs).collect():
        want[r["source"]] += r["taken"]
    found = Counter()
    for r in pipeline.mix_sources(spark, docs, sf_dir).collect():
        found[r["source"]] += len(r["text"].split())
    assert +found == +want


def test_the_whole_run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    clean = pipeline.drop_toxic(spark, docs, sf_dir)
    scored = {r["doc_id"]: r["predicted"] for r in queries.op5_toxicity(spark, sf_dir).collect()}
    assert sorted(pairs(clean)) == sorted((i, t) for i, t in pairs(docs) if scored[i] == 0)
    lined = brute.not_emptied(pairs(clean))
    stay = {r[0] for r in brute.near(lined, 5) if r[3]}
    lined = {i: t for i, t in lined if i in stay}
    sources = {r["doc_id"]: r["source"] for r in docs.select("doc_id", "source").collect()}
    left = spark.createDataFrame([(i, t, sources[i]) for i, t in lined.items()], "doc_id long, text string, source string")
    copies = {r["doc_id"]: r["copies"] for r in mix(left).collect() if r["copies"]}

    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer_path())
    tokens = {i: len(t.encode(lined[i], add_special_tokens=False).ids) + 1 for i in copies}
    folder = f"{shared_root(spark)}/claimscope"
    held = set(os.listdir(folder))
    rows = pipeline.run(spark, sf_dir).collect()
    (left_over,) = set(os.listdir(folder)) - held
    assert left_over.startswith("pipeline-packing-")
    found: Counter = Counter()
    for r in rows:
        found[r["doc_id"]] += r["length"]
    assert found == {i: n * tokens[i] for i, n in copies.items()}
    filled: Counter = Counter()
    for r in rows:
        filled[r["sequence_id"]] += r["length"]
    assert max(filled.values()) <= 2048 and len(filled) <= 1.05 * -(-sum(filled.values()) // 2048) + 1
