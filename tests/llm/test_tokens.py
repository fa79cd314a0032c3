"""Token files, packing, mixing, vectors and the pipeline against plain Python."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from rosterforge.llm import bag_minhash, chunk_dedup, pigeonhole_join, source_mix, ss_packing, token_files
from rosterforge.llm.word_tokens import WordTokens
from rosterforge.session import durable_path
from tests.conftest import SF
from tests.llm.conftest import ODD_ROWS

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(PATH)


def ids_of(reference, text):
    return [*reference.encode(text or "", add_special_tokens=False).ids, 2]


def test_words_give_the_ids_of_whole_texts(reference):
    rng = np.random.default_rng(3)
    letters = list("abzABZ 's'T\n\t\x0b\x0c\r\x1c\x85\xa0 　éȨ́ÅΣσςİıß,.!?|*$中文123²​\U0001f600ÉÀÿ×÷") + [
        "<|endoftext|>", "<|STARTOFTEXT|>", "we'LL", "gröÙe***", "é", "naïve,", "don't.", "x's",
    ]
    words = WordTokens(PATH, most_bytes=150_000)
    assert words.spelled is not None
    for _ in range(4000):
        text = "".join(rng.choice(letters, rng.integers(0, 25)))
        assert words.encode(text.encode()) == np.array(ids_of(reference, text)[:-1], "<u4").tobytes(), repr(text)
    assert 0 < len(words.older) <= 600 and len(words.known) <= 600


def placed(rows, reference):
    """doc_id, start, count and checksum of each row in file order."""
    def number(row):
        return (row[0] is not None, row[0] or 0)

    out, at = Counter(), 0
    groups = defaultdict(list)
    for row in rows:
        groups[number(row)].append(row)
    for key in sorted(groups):
        for doc_id, text in groups[key]:
            ids = ids_of(reference, text)
            out[(doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))] += 1
            at += len(ids)
    return out, at


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_token_files(spark, odd, reference, encoding):
    path = durable_path(spark, "test-tokens")
    token_files.write(odd, path, PATH, encoding=encoding, page_rows=2)
    rows = token_files.digests(token_files.read(spark, path)).collect()
    expected, total = placed([r[:2] for r in ODD_ROWS], reference)
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows) == expected
    ordered = sorted(rows, key=lambda r: r["start"])
    assert [r["start"] for r in ordered] == np.cumsum([0] + [r["n_tokens"] for r in ordered])[:-1].tolist()
    keys = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in ordered]
    assert keys == sorted(keys) and total == sum(r["n_tokens"] for r in rows)
    files = [f for f in spark.read.parquet(path).inputFiles()]
    kinds, indexed = set(), True
    for file in files:
        meta = pq.ParquetFile(file.removeprefix("file://")).metadata
        for group in range(meta.num_row_groups):
            column = meta.row_group(group).column(3)
            kinds |= set(column.encodings)
            indexed &= column.has_offset_index and meta.row_group(group).column(0).has_column_index
    assert indexed and (("DELTA_BINARY_PACKED" in kinds) == (encoding == "delta"))


def test_token_files_of_given_documents(spark, reference):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    path = durable_path(spark, "test-tokens")
    token_files.write(docs.repartition(5), path, PATH)
    rows = {r["doc_id"]: r for r in token_files.digests(token_files.read(spark, path)).collect()}
    at = 0
    for doc in sorted(docs.collect(), key=lambda r: r["doc_id"]):
        ids = ids_of(reference, doc["text"])
        row = rows[doc["doc_id"]]
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_empty_token_files(spark, empty):
    path = durable_path(spark, "test-tokens")
    token_files.write(empty, path, PATH)
    assert token_files.digests(token_files.read(spark, path)).count() == 0


def check_pieces(rows, texts, reference, window):
    """Every id of every document in exactly one piece; sequences gapless, full or a power of two."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"] > 0
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    wanted = defaultdict(list)
    for doc_id, text in texts:
        wanted[doc_id].append(ids_of(reference, text))
    assert set(by_doc) == set(wanted)
    for doc_id, documents in wanted.items():
        pieces = Counter((r["start"], tuple(r["ids"]), r["doc_tokens"]) for r in by_doc[doc_id])
        for ids in documents:
            at = 0
            while at < len(ids):
                fit = [k for k in pieces if k[0] == at and k[2] == len(ids) and list(k[1]) == ids[at : at + len(k[1])]]
                assert fit, (doc_id, at)
                pieces -= Counter([fit[0]])
                at += len(fit[0][1])
        assert not pieces
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r["offset"])
        lengths = [r["length"] for r in pieces]
        assert [r["offset"] for r in pieces] == np.cumsum([0] + lengths)[:-1].tolist()
        total = sum(lengths)
        assert total <= window and (total == window or total & (total - 1) == 0)


@pytest.mark.parametrize(("window", "most_open_bytes"), [(4096, 64 << 20), (64, 1200)])
def test_packing(odd, reference, window, most_open_bytes):
    rows = ss_packing.pack(odd, PATH, window=window, most_open_bytes=most_open_bytes).collect()
    check_pieces(rows, [r[:2] for r in ODD_ROWS], reference, window)


def test_packing_of_given_documents(spark, empty, reference):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = ss_packing.pack(docs.repartition(3), PATH).collect()
    check_pieces(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], reference, 4096)
    assert ss_packing.pack(empty, PATH).count() == 0


def test_level_minimises_squared_counts():
    rng = np.random.default_rng(0)
    packer = ss_packing.Packer(window=32)
    for i in range(600):
        size = int(rng.integers(1, 32))
        before = packer.counts.copy()

        def squares(level, size=size, before=before):
            after = before.copy()
            after[level] -= level > 0
            if level + size < 32:
                after[level + size] += 1
            return int((after**2).sum())

        options = [0] + [h for h in range(1, 33 - size) if before[h]]
        assert squares(packer.level_for(size)) == min(map(squares, options))
        packer.add(i, bytes(4 * size))
        assert (packer.counts[0], packer.counts[32]) == (0, 0)
        assert all(len(packer.open.get(h, [])) == packer.counts[h] for h in range(33))


def expected_targets(sizes):
    """Water filling by rounds, as the rule says it."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, left, open_ = {}, float(sum(sizes.values())), set(names)
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > 3 * sizes[s] + 1e-9]
        if not over:
            for s in open_:
                target[s] = left * weight[s] / total
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
        left -= sum(target[s] for s in over)
        open_ -= set(over)
    return target


def check_mix(rows, source_of, block):
    sizes, taken = Counter(), Counter()
    for r in rows:
        sizes[source_of[r["doc_id"]]] += r["size"]
        taken[source_of[r["doc_id"]]] += r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    target = expected_targets(dict(sizes) | {s: 0 for s in set(source_of.values()) - set(sizes)})
    for r in rows:
        source = source_of[r["doc_id"]]
        assert r["source_size"] == sizes[source] and abs(r["target"] - target[source]) < 1e-6 * max(1, target[source])
    for source, words in target.items():
        assert abs(taken[source] - words) <= 1


@pytest.mark.parametrize(("block", "shard_slots"), [(64, 1 << 16), (7, 10)])
def test_mix_of_given_documents(spark, block, shard_slots):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    source_of = {r["doc_id"]: r["source"] for r in docs.collect()}
    one = source_mix.taken(docs, block=block, shard_slots=shard_slots).collect()
    assert len(one) == len(source_of)
    check_mix(one, source_of, block)
    again = source_mix.taken(docs.repartition(7), block=block, shard_slots=shard_slots).collect()
    assert {r["doc_id"]: r["taken"] for r in one} == {r["doc_id"]: r["taken"] for r in again}


def test_mix_with_small_sources(spark, docs_of):
    rows = [(i, " ".join(["w"] * (i % 13)), "en", s) for i, s in enumerate("aaaaaaaaaaaaaaaaaaaaaaabbbbbcd" * 4)]
    rows += [(1000, None, "en", "empty"), (1001, "", "en", None), (1002, "one two", "en", None)]
    docs = docs_of(rows)
    check_mix(source_mix.taken(docs, block=5).collect(), {r[0]: r[3] for r in rows}, 5)


def test_streams_are_dealt_evenly(spark):
    # two thirds of the rows are in one source, half of those are one repeated row without an id
    rows = [(i, None if i % 3 == 0 else i, 7 if i % 3 == 0 else i, 0 if i % 3 < 2 else i % 5, i % 4) for i in range(24_000)]
    narrow = spark.createDataFrame(rows, "uid long, doc_id long, text_hash long, source_no long, size long")
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(setting)
    try:
        spark.conf.set(setting, "false")
        counts = [r["count"] for r in source_mix._dealt(narrow).groupBy("_task").count().collect()]
        placed = source_mix.streams(narrow).collect()
    finally:
        spark.conf.set(setting, old)
    assert len(counts) > 2 and max(counts) < 2 * sum(counts) / len(counts)
    assert sorted(r["uid"] for r in placed) == list(range(24_000))
    reach = Counter()
    for r in sorted(placed, key=lambda r: (r["source_no"], r["at"], r["at"] + r["size"])):
        assert r["at"] == reach[r["source_no"]]
        reach[r["source_no"]] += r["size"]


def test_mix_rows(spark, docs_of, odd, empty):
    rows = [(i, " ".join(f"d{i}w{j}" for j in range(40 + i)), "en", "abc"[i % 3] if i else None) for i in range(60)]
    docs = docs_of(rows)
    made = source_mix.apply(docs, block=8)
    assert made.schema == docs.schema
    words = {r[0]: r[1].split() for r in rows}
    taken = {r["doc_id"]: r["taken"] for r in source_mix.taken(docs, block=8).collect()}
    found, uses = Counter(), Counter()
    for r in made.collect():
        got = r["text"].split()
        assert r["n_chars"] == len(r["text"]) and len(set(got)) == len(got)
        places = [words[r["doc_id"]].index(w) for w in got]
        assert places == sorted(places)
        if len(got) == len(words[r["doc_id"]]):
            assert r["text"] == " ".join(words[r["doc_id"]])
        found[r["doc_id"]] += len(got)
        uses.update(got)
    assert {k: v for k, v in taken.items() if v} == dict(found) and max(uses.values()) <= 3
    assert source_mix.apply(odd).schema == odd.schema and source_mix.apply(odd).count() > 0
    assert source_mix.taken(odd).count() == len(ODD_ROWS)
    assert source_mix.apply(empty).count() == 0 and source_mix.taken(empty).count() == 0


def test_permutation_and_draws():
    for n in (1, 2, 3, 17, 100, 1025):
        for key in (0, 9):
            found = source_mix.permuted(np.arange(n), np.full(n, n), np.full(n, key, np.uint64))
            assert sorted(found.tolist()) == list(range(n))
    share = np.array([0.5, 0.3, 0.15, 0.05])
    draws = np.array([source_mix.draw(k, 11, share, 1) for k in range(4000)])
    assert (draws.sum(axis=1) == 11).all() and np.abs(draws.mean(axis=0) - 11 * share).max() < 0.05
    assert (source_mix.draw(5, 11, share, 1) == source_mix.draw(5, 11, share, 1)).all()
    # counts spread as those of a multinomial draw over all slots of a shard
    draws = np.array([source_mix.draw(k, 1000, share, 2) for k in range(4000)])
    expected = 1000 * (np.diag(share) - np.outer(share, share))
    assert np.abs(np.cov(draws.T) - expected).max() < 0.1 * expected.max()


def expected_links(rows, threshold=0.9):
    good = []
    for i, (_, e) in enumerate(rows):
        if e and all(v is not None and np.isfinite(v) for v in e) and any(e):
            x = np.array(e, np.float64)
            good.append((i, x / np.linalg.norm(x)))
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    n = Counter()
    for k, (i, x) in enumerate(good):
        for j, y in good[:k]:
            if len(x) == len(y) and x @ y >= threshold:
                n[i] += 1
                n[j] += 1
                parent[top(i)] = top(j)
    least = {}
    for i, (vec_id, _) in enumerate(rows):
        least[top(i)] = min(least.get(top(i), vec_id), vec_id)
    return Counter((vec_id, n[i], least[top(i)], vec_id == least[top(i)]) for i, (vec_id, _) in enumerate(rows))


@pytest.mark.parametrize(("size", "cell", "chunk"), [(16, 40, 16), (5, 10_000, 7), (1, 50, 50)])
def test_vector_links(spark, monkeypatch, size, cell, chunk):
    monkeypatch.setattr(pigeonhole_join, "CELL", cell)
    monkeypatch.setattr(pigeonhole_join, "LIVES", chunk)
    monkeypatch.setattr(pigeonhole_join, "MEETS", 2 * chunk)
    rng = np.random.default_rng(size)
    centres = rng.normal(size=(12, size))
    rows = []
    for i in range(260):
        spread = 0.02 if i % 7 == 0 else 0.5
        e = centres[rng.integers(12)] + rng.normal(0, spread, size)
        rows.append((i * 3, (e * rng.uniform(0.1, 5)).astype(np.float32).tolist()))
    rows += [(10_000 + i, rows[3][1]) for i in range(9)]
    rows += [(2, None), (5, []), (8, [0.0] * size), (11, [None] * size), (14, [float("nan")] + [1.0] * (size - 1))]
    rows += [(17, [float("inf")] * size), (20, [1.0] * (size + 1)), (23, [1.0] * (size + 1)), (26, [-0.0] + [1.0] * size)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, rid string, copies int")
    found = pigeonhole_join.link(docs.repartition(4)).collect()
    assert Counter(tuple(r[k] for k in ("vec_id", "n_links", "component_id", "kept")) for r in found) == expected_links(rows)
    assert pigeonhole_join.link(docs.limit(0)).count() == 0


def test_pipeline(spark, reference):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.durable(stage(spark, docs, SF), f"test-{name}")
        seen[name] = docs
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    near = seen["minhash_near_dedup"].collect()
    assert len({r["doc_id"] for r in near}) == len(near)
    assert len({(r["text"] or "").lower() for r in near}) == len(near)
    mixed = [(r["doc_id"], r["text"]) for r in seen["source_mix"].collect()]
    assert {i for i, _ in mixed} <= {r["doc_id"] for r in near}
    check_pieces(docs.collect(), mixed, reference, 4096)


def test_pipeline_over_odd_and_no_rows(spark, odd, empty, tmp_path):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    for name, docs in (("odd", odd.withColumnRenamed("uid", "a.b")), ("empty", empty)):
        folder = str(tmp_path / name)
        docs.write.parquet(f"{folder}/documents.parquet")
        labels.write.parquet(f"{folder}/labels.parquet")
        kept = docs
        for stage, function in corpus_pipeline.STAGES[:-1]:
            kept = corpus_pipeline.durable(function(spark, kept, folder), f"odd-{stage}")
            assert kept.columns == docs.columns
        rows = corpus_pipeline.run(spark, folder).collect()
        assert {r["doc_id"] for r in rows} <= {r["doc_id"] for r in docs.collect()}
        assert rows or name == "empty"


def test_columns_with_dots_stay(spark, odd):
    docs = odd.withColumnRenamed("uid", "a.b").withColumnRenamed("size", "c`d")
    for stage in (chunk_dedup.unique, bag_minhash.one_of_each, source_mix.apply):
        kept = stage(docs)
        assert kept.columns == docs.columns and kept.count() > 0


def test_letters_of_ascii_are_not_spelled_anew():
    class Latin(dict):
        def __missing__(self, letter):
            raise AssertionError(chr(letter))

    words = WordTokens(PATH)
    words.spelled = Latin(words.spelled)
    texts = ["thndhain*** the&&& of", "grün, 12 é! a'b", "x" * 3000 + "1 " + "ab" * 2000]
    whole = words.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(words.encode(t.encode()), np.uint32).tolist() for t in texts[:1]] == [whole[0].ids]
    words.spelled = dict(words.spelled)
    assert [np.frombuffer(words.encode(t.encode()), np.uint32).tolist() for t in texts] == [w.ids for w in whole]
