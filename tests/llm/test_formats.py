"""Token files, vector codes and the prefix trie."""

from __future__ import annotations

import hashlib
import random
import shutil
import zlib

import duckdb
import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from claimscope.llm import queries
from claimscope.llm.common import table
from claimscope.llm.prefix_trie import NOBODY, SpillingQueue, prefix_trie, rebuilt_trie, subtree_totals, turn_rows, within_shard, across_shards
from claimscope.llm.token_files import TokenFile, TokenFileWriter, WordEncoder, open_store, read_digests, read_documents, read_manifest, token_digests, write_tokens
from claimscope.llm.vector_codes import compress_vectors, code_report, exact_type, trie_nearest

WORDS = queries.tokenizer_path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORDS)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


# token files
def digests(rows, plain):
    """What the files hold, by the library alone: rows in the order of the files."""
    out, at = [], 0
    for doc, text in rows:
        ids = [*plain(text), 1]
        out.append((doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_encoder_agrees_with_the_library(plain):
    dice = random.Random(5)
    bits = ["a", "B", " ", "\n", "\t", " ", "\r\n", "é", "é", "́", "İ", "Σ", "ß", "한", "하", "漢字", "😀", "'s", "'LL", "12", "<|endoftext|>", "<|startoftext|>",
            "<", "|", "‍", " ", "\u0085", "\0", "word", "Word", "...", "ﬁ", "̣̇", "　"]
    encoder = WordEncoder(WORDS, remember=50)
    for _ in range(3000):
        text = "".join(dice.choices(bits, k=dice.randrange(12)))
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == plain(text), repr(text)


def test_token_files_on_odd_rows(odd, none, plain):
    got = [tuple(r)[:4] for r in token_digests(odd, WORDS).orderBy("start").collect()]
    texts = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert [r[0] for r in got] == sorted((i for i, _ in texts if i is not None)) + [None, None]
    wanted = digests(texts, plain)
    assert sorted(((r[0], *r[2:]) for r in got), key=repr) == sorted(((r[0], *r[2:]) for r in wanted), key=repr)
    ends = [r[1] + r[2] for r in got]
    assert [r[1] for r in got] == [0, *ends[:-1]]
    assert token_digests(none, WORDS).count() == 0


def test_token_files_of_a_table(spark, sf_dir, plain):
    texts = sorted((r["doc_id"], r["text"]) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect())
    got = queries.op11_token_files(spark, sf_dir).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == digests(texts, plain)


def test_readers_open_only_what_they_need(spark, plain, tmp_path):
    rows = [(i % 500 if i % 3 else 77, f"document {i} " + "word " * (i % 40)) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    folder = f"file://{tmp_path}/files"
    manifest = write_tokens(docs, folder, WORDS, frame_ids=64, index_docs=16, files=9)
    assert manifest.count() == 9 and manifest.agg(F.sum("docs")).first()[0] == 1500  # a third share one id and still spread
    store, root = open_store(folder)
    with store.open_output_stream(f"{root}/tokens-000000-of-a-lost-attempt.zst") as out:
        out.write(b"not a token file")
    assert read_manifest(spark, folder).count() == manifest.count()
    wanted = spark.createDataFrame([(3,), (77,), (77,), (499,), (100_000,), (-1,), (None,)], "doc_id long")
    got = sorted((r["doc_id"], list(r["ids"])) for r in read_documents(folder, manifest, wanted).collect())
    assert got == sorted((i, [*plain(t), 1]) for i, t in rows if i in (3, 77, 499))
    one = spark.createDataFrame([(3,)], "doc_id long")
    assert all(r["frames"] <= -(-len(r["ids"]) // 64) + 1 for r in read_documents(folder, manifest, one).collect())
    digest = read_digests(folder, manifest).agg(F.sum("n_tokens"), F.max(F.col("start") + F.col("n_tokens"))).first()
    assert digest[0] == digest[1] == sum(len(plain(t)) + 1 for _, t in rows)


def test_a_file_by_itself(tmp_path):
    docs = [(1, 5), (2, 0), (2, 300), (4, 1), (None, 7), (None, 0)]
    ids = {n: np.arange(7 * n, 7 * n + size, dtype="<u4") for n, (_, size) in enumerate(docs)}
    path = str(tmp_path / "f.zst")
    with open(path, "wb") as out:
        writer = TokenFileWriter(out, frame_ids=16, index_docs=2)
        for n, (doc, _) in enumerate(docs):
            writer.add(doc, ids[n].tobytes())
        writer.close()
    store, _ = open_store(str(tmp_path))
    with store.open_input_file(path) as source:
        file = TokenFile(source)
        assert [(d, e - s) for d, s, e in file.documents()] == docs and file.data_frames == 20
        before = file.unpacked
        assert [(d, e - s) for d, s, e in file.find([2, 3, 2])] == [(2, 0), (2, 300)]
        found = list(file.find([4]))
        assert b"".join(file.parts(*found[0][1:])) == ids[3].tobytes() and file.unpacked - before < 10
    with open(path, "rb") as f:  # any zstandard tool reads the frames one after the other
        whole = zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read()
    assert whole.startswith(b"".join(ids[n].tobytes() for n in range(len(docs))))

    raw = bytearray(open(path, "rb").read())
    raw[file.offsets[3] + 7] ^= 1
    open(path, "wb").write(raw)
    with store.open_input_file(path) as source:
        damaged = TokenFile(source)
        damaged.frame(2)
        with pytest.raises(ValueError):
            damaged.frame(3)
    for cut in (raw[:-1], raw[:40], raw[:-30] + raw[-9:]):
        open(path, "wb").write(cut)
        with store.open_input_file(path) as source, pytest.raises(ValueError):
            TokenFile(source)
    shutil.rmtree(tmp_path)


# vector codes
def plain_codes(rows, parts=4, entries=256, rounds=4, scale=1024):
    """(id, code, error, label) and the codebooks, by comparing every part with every entry. Whole numbers of any size."""
    import math

    good = [(i, [math.floor(scale * c) for c in v], label) for i, v, label in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = -(-max((len(v) for _, v, _ in good), default=0) // parts)
    good = [(i, v + [0] * (parts * width - len(v)), label) for i, v, label in good]
    order = sorted(good, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    books = [[r[1][p * width:(p + 1) * width] for r in order[:entries]] for p in range(parts)]

    def nearest(book, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), n) for n, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            groups: dict = {}
            for _, v, _ in good:
                part = v[p * width:(p + 1) * width]
                groups.setdefault(nearest(book, part)[1], []).append(part)
            books[p] = [[sum(c) // len(c) for c in zip(*groups[n], strict=True)] if n in groups else e for n, e in enumerate(book)]
    out = []
    for i, v, label in good:
        best = [nearest(books[p], v[p * width:(p + 1) * width]) for p in range(parts)]
        out.append((i, "".join(f"{n:02x}" for _, n in best), sum(d for d, _ in best), label))
    return out, books


def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns({"id": F.lit("x"), "x": F.lit(1), "code": F.lit(2)})


@pytest.mark.parametrize("far", [1.0, 1e4, 3e5, 2.0 ** 30])
def test_codes_of_odd_vectors(spark, far):
    dice = random.Random(int(far))
    rows = [(i, [far * dice.choice([-0.5, 0.25, 0.126, -1 / 1024 / 3, 0.0]) for _ in range(10)], i % 3 if i % 4 else None) for i in range(90)]
    rows += rows[10:14] + [(7, rows[8][1], 1), (None, rows[3][1], 2), (None, [0.0] * 10, None), (95, None, 1), (96, [1.0, None], 1), (97, [float("nan")] * 10, 1),
                           (98, [float("inf")] * 10, 1), (99, [], 1), (100, [0.5] * 3, 2), (101, [0.5] * 9, 2)]
    want, books = plain_codes(rows, entries=12)
    if far >= 2.0 ** 30:  # errors beyond a long; nearest entries are still exact
        big = np.array(sorted({tuple(int(1024 * c) for c in v[:3]) for _, v, _ in rows[:90]}), object)
        assert exact_type(3, int(abs(big).max())) is object
        got, errors = trie_nearest(big, big[:5])
        brute = [min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), n) for n, e in enumerate(big[:5].tolist())) for x in big.tolist()]
        assert [(e, n) for n, e in zip(got.tolist(), errors.tolist(), strict=True)] == brute
        return
    for block in (7, 1 << 15):
        got = compress_vectors(vectors_of(spark, rows), entries=12, block=block)
        assert [b.tolist() for b in got.books] == books
        assert sorted(((r["id"], r["code"].hex(), r["error"], r["label"]) for r in got.codes.collect()), key=repr) == sorted(want, key=repr)


def test_codes_of_a_table(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf_dir}/embeddings.parquet')")
    sql = con.execute(queries.SQL["op12_vector_codes"])
    names = [d[0] for d in sql.description]
    got = queries.op12_vector_codes(spark, sf_dir)
    assert sorted(tuple(r[n] for n in names) for r in got.collect()) == sorted(sql.fetchall())


def test_codes_decode_to_their_entries(spark, sf_dir):
    found = compress_vectors(table(spark, sf_dir, "embeddings"), entries=8)
    for r in found.decode(found.codes).limit(20).collect():
        assert list(r["decoded"]) == [c for p, n in enumerate(r["code"]) for c in found.books[p][n].tolist()]


def test_codes_of_nothing(spark):
    assert code_report(vectors_of(spark, [])).count() == 0
    got = code_report(vectors_of(spark, [(1, [], 2), (2, None, 2), (3, [], None)])).collect()
    assert sorted(tuple(r)[:4] for r in got) == [(1, "00000000", 0, 0), (3, "00000000", 0, 0)]


def test_trie_takes_the_lower_of_equal_entries():
    parts = np.array(sorted({(a, b, c) for a in range(6) for b in range(0, 6, 2) for c in (-3, 0, 3)}), np.int32)
    book = np.array([[1, 1, 1], [0, 4, 0], [1, 1, 1], [5, 5, -3], [9, 9, 9]], np.int32)
    for wide in (1, 2, 1024):
        nearest, error = trie_nearest(parts, book, wide)
        distances = ((parts[:, None, :] - book[None, :, :]) ** 2).sum(axis=2)
        assert nearest.tolist() == distances.argmin(axis=1).tolist() and error.tolist() == distances.min(axis=1).tolist()


# prefix trie
def plain_trie(rows, group=100, leads=6):
    """(conv, turn, role, text) rows to node rows, by walking up from every conversation's turns."""
    convs: dict = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            convs.setdefault(c, []).append((turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest(), role, text))
    said = {c: [t[3:] for t in sorted(ts)] for c, ts in convs.items()}
    nodes: dict = {}
    for c in said:
        h = zlib.crc32(str(c).encode()) % leads
        turns = tuple(said.get(c - c % group, [])[:h] + said[c][h:])
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append((c, d == len(turns)))
    out = []
    for key, members in nodes.items():
        under = [k for k in nodes if k[:len(key)] == key]
        kids = [k for k in under if len(k) == len(key) + 1]
        leaves = [k for k in under if not any(len(o) == len(k) + 1 and o[:len(k)] == k for o in under)]
        ends = ",".join(str(c) for c in sorted(c for c, last in members if last))
        parent = min(c for c, _ in nodes[key[:-1]]) if key else None
        saved = sum((len(nodes[k]) - 1) * len(k[-1][1]) for k in under if k)
        out.append((min(c for c, _ in members), len(key), parent, len(members), len(kids), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def trie_rows(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def test_trie_of_odd_conversations(spark):
    dice = random.Random(3)
    rows = [(c, t, dice.choice(["user", "assistant", None, ""]), dice.choice(["", None, "a", "é😀", "a longer text"]))
            for c in [*range(0, 40), *range(100, 112), *range(205, 230)] for t in range(dice.randrange(1, 9))]
    rows += [(7, None, "user", "first"), (7, 0, "user", "tie"), (7, 0, "user", "tie"), (None, 1, "user", "x"), (None, None, None, None), (300, 5, None, "only")]
    rows += [(c, t, "user", "same") for c in range(400, 440) for t in range(7)]  # copies
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"depth": F.lit(1), "node": F.lit("x"), "place": F.lit(0)})
    want = plain_trie(rows)
    assert trie_rows(rebuilt_trie(df)) == want
    assert any(r[0] == 300 or r[1] == 0 and r[7] != NOBODY for r in want)  # conversations without a turn end at the root


def test_trie_of_a_long_conversation_and_of_nested_ones(spark):
    rows = [(100 * c, t, "user", f"t{t}") for c in range(30) for t in range(c)] + [(10_000, t, "user", str(t)) for t in range(700)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = turn_rows(df)
    assert trie_rows(prefix_trie(turns, turns.where("place = 0").select("conv_id", "turns"), limit=5)) == plain_trie(rows, group=1)


def test_trie_of_nothing(spark):
    assert rebuilt_trie(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_trie_of_a_table(spark, sf_dir):
    rows = [tuple(r) for r in table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert trie_rows(queries.op13_prefix_trie(spark, sf_dir)) == plain_trie(rows)


def test_queue_spills_and_adds_up(tmp_path):
    dice = random.Random(1)
    queue, want = SpillingQueue(str(tmp_path / "spill"), limit=10), {}
    for _ in range(500):
        key, n = (-dice.randrange(5), dice.choice("abcdef")), dice.randrange(100)
        queue.push(key, (1, n, -n))
        a = want.get(key, (0, 0, 0))
        want[key] = (a[0] + 1, a[1] + n, a[2] - n)
    assert queue.spilled > 10
    got = []
    while queue.least() is not None:
        got.append(queue.take())
    assert got == sorted(want.items())
    queue.close()
    assert not list((tmp_path / "spill").iterdir())


def test_totals_for_any_cut_into_shards(tmp_path):
    """Shards of a depth-first order, cut anywhere, give the totals of the whole tree."""
    dice = random.Random(9)
    paths = {"0" * 16}
    while len(paths) < 120:
        paths.add(dice.choice(sorted(paths)) + f"{dice.randrange(4):016x}")
    nodes = {p: (dice.randrange(2), dice.randrange(50)) for p in paths}
    want = {p: (sum(len(q) == len(p) + 16 and q.startswith(p) for q in paths), *(sum(nodes[q][i] for q in paths if q.startswith(p)) for i in (0, 1))) for p in paths}
    for shards in (1, 2, 7, 40, 120):
        cuts = sorted(dice.sample(range(1, 120), shards - 1))
        found, sent = {}, {}
        for a, b in zip([0, *cuts], [*cuts, 120], strict=True):
            part = sorted(sorted(paths)[a:b], key=lambda p: (-len(p), p))
            for path, outside, *sums in within_shard(iter([(p, 0, *nodes[p]) for p in part]), SpillingQueue(str(tmp_path), 3)):
                side = sent if outside else found
                side[path] = tuple(x + y for x, y in zip(side.get(path, (0, 0, 0)), sums, strict=True))
        for path, _, *sums in across_shards(iter([(p, *sent[p]) for p in sorted(sent, key=lambda p: (-len(p), p))]), SpillingQueue(str(tmp_path), 3)):
            found[path] = tuple(x + y for x, y in zip(found[path], sums, strict=True))
        assert found == want


def test_subtree_totals_spread(spark):
    rows = [("0" * 16 + f"{i % 50:016x}" + f"{i:016x}", 1, i) for i in range(2000)] + [("0" * 16 + f"{i:016x}", 0, 1) for i in range(50)] + [("0" * 16, 0, 0)]
    df = spark.createDataFrame(rows, "path string, leaves long, saved long")
    got = {r["path"]: (r["kids"], r["leaves"], r["saved"]) for r in subtree_totals(df, limit=20).collect()}
    assert got["0" * 16] == (50, 2000, sum(range(2000)) + 50) and got["0" * 16 + f"{3:016x}"] == (40, 40, 1 + sum(range(3, 2000, 50))) and len(got) == 2051
