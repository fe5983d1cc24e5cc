"""Jaccard join, packing, archive, embeddings and pipeline against brute force."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from greensward.llm import embedding_dedup, flat_graph, mixing, ngram_join, packing, token_archive
from greensward.llm.prefix_trie import linked_forest, linked_to
from greensward.llm.shingles import Shingler
from greensward.llm.token_ids import ChunkEncoder, default_tokenizer, encoder

SF = "/root/testdata/sf0.01"
LOW = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def roots(n, pairs):
    p = {i: i for i in n}

    def find(x):
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        p[max(a, b)] = min(a, b)
    return {i: find(i) for i in n}


def brute_jaccard(rows, words, percent):
    sets, inverse, links = {}, defaultdict(list), []
    for i, t in rows:
        w = (t or "").encode().translate(LOW).split()
        sets[i] = {tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()
        common = defaultdict(int)
        for s in sets[i]:
            for j in inverse[s]:
                common[j] += 1
            inverse[s].append(i)
        links += [(i, j) for j, o in common.items() if 100 * o >= percent * (len(sets[i]) + len(sets[j]) - o)]
    r = roots(sets, links)
    return {i: (len(s), r[i]) for i, s in sets.items()}


def test_forest_has_the_components_of_all_links():
    rng = np.random.default_rng(0)
    for _ in range(300):
        base = [np.unique(rng.integers(0, 60, rng.integers(1, 40))) for _ in range(3)]
        sets = []
        for _ in range(rng.integers(1, 25)):
            b = base[rng.integers(3)]
            s = np.union1d(b[rng.random(len(b)) > rng.choice([0, 0.05, 0.1])], rng.integers(0, 60, rng.integers(0, 3)))
            sets.append((s if len(s) else b).astype(np.uint64))
        percent, sizes = int(rng.choice([50, 80, 85])), np.array([len(s) for s in sets])
        like = lambda a, b: 100 * len(np.intersect1d(a, b)) >= percent * len(np.union1d(a, b))
        links = [(i, j) for i in range(len(sets)) for j in range(i) if like(sets[i], sets[j])]
        for joined in (0, len(sets) // 3):
            layers = np.full(len(sets), -1)
            layers[:joined] = 0
            got = linked_forest(sets, sizes, layers, percent)
            assert all(like(sets[a], sets[b]) for a, b in got)
            pre = [(0, i) for i in range(joined)]
            assert roots(range(len(sets)), links + pre) == roots(range(len(sets)), got + pre)
        # a token of one set alone may stay away, if the sizes count it
        seen = np.unique(np.concatenate(sets), return_counts=True)
        short = [s[np.isin(s, seen[0][seen[1] > 1])] for s in sets]
        got = linked_forest(short, sizes, np.full(len(sets), -1), percent)
        assert all(like(sets[a], sets[b]) for a, b in got) and roots(range(len(sets)), links) == roots(range(len(sets)), got)
        hub = linked_to(short[0], int(sizes[0]), short[1:], sizes[1:], percent)
        assert sorted(hub + 1) == [i for i in range(1, len(sets)) if like(sets[0], sets[i])]


def test_shingles():
    s = Shingler(4)
    assert (s(b"the quick Brown  fox jumps\nover") == s(b"The QUICK brown fox\tjumps over")).all()
    assert len(s(b" \n")) == 0 and len(s(b"a b")) == 1 and s(b"a b")[0] != s(b"b a")[0] and len(s(b"a b c d " * 9)) == 4
    long = b"word " * 40_000
    assert len(s(long)) == 1


@pytest.mark.parametrize("block", [64, 4])
def test_jaccard_on_the_tables(spark, monkeypatch, block):
    """Small blocks send the groups through hubs and pairs of blocks."""
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", block)
    d = pd.read_parquet(f"{SF}/documents.parquet")
    got = ngram_join.op1_ngram_join(spark, SF).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_jaccard(zip(d.doc_id, d.text), 4, 85) and len(got) == len(d)


def near_copies(seed, groups=6, each=30):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows = []
    for _ in range(groups):
        base = [word() for _ in range(rng.randint(30, 120))]
        for _ in range(each):
            w = list(base)
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = word()
            rows.append((len(rows), " ".join(w)))
    return rows


@pytest.mark.parametrize("block", [64, 6])
def test_jaccard_on_near_copies(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", block)
    rows = near_copies(block)
    got = ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), words=5, percent=80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_jaccard(rows, 5, 80)


def test_a_passage_in_all_documents(spark, monkeypatch):
    """Its shingles come to their groups once for each flush; dense and chained groups meet in bounded tries; all links hold."""
    for name, value in (("BLOCK_SETS", 8), ("HUB_SETS", 16), ("HOT_SETS", 20), ("FLUSH_SHINGLES", 4000)):
        monkeypatch.setattr(ngram_join, name, value)
    passage = " ".join(f"common{k}" for k in range(60))
    rows = [(i, f"{passage} " + " ".join(f"d{i}x{k}" for k in range(12))) for i in range(300)]
    rows += [(1000 + i, t + " " + passage) for i, t in near_copies(3, groups=3, each=40)]
    # a chain: each is linked with the next alone
    chain = [f"c{k}" for k in range(900)]
    rows += [(5000 + i, " ".join(chain[6 * i : 6 * i + 100])) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    sent = []
    real = ngram_join._trie_join
    monkeypatch.setattr(ngram_join, "_trie_join", lambda d, p: sent.append(d.groupBy("c", "i", "j").count().agg(F.max("count")).first()[0]) or real(d, p))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(df, words=3, percent=85).collect()}
    assert got == brute_jaccard(rows, 3, 85)
    assert len({c for i, (_, c) in got.items() if i >= 5000}) < 120 and max(n or 0 for n in sent) <= 32
    counted = {r.shared for r in ngram_join.shared_counts(df, 3, 64).collect()}
    assert counted and max(counted) >= 58


def test_jaccard_edges(spark):
    t = " ".join(f"w{k}" for k in range(40))
    rows = [(5, t, 1), (5, t, 1), (3, t.upper(), 1), (7, None, 1), (8, "", 1), (9, " \n", 1), (10, "a b", 1), (11, "A  B", 1), (12, "b a", 1), (None, t, 1), (4, t + " w40", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toks int").withColumns({"component_id": F.lit(1), "n": F.lit(2)})
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(df, words=4, percent=85).collect()), key=str)
    want = [(5, 37, 3), (5, 37, 3), (3, 37, 3), (7, 0, 7), (8, 0, 8), (9, 0, 9), (10, 1, 10), (11, 1, 10), (12, 1, 12), (None, 37, None), (4, 38, 3)]
    assert got == sorted(want, key=str)
    assert ngram_join.jaccard_components(df.where("false")).count() == 0


# tokens ---------------------------------------------------------------------------------


def test_repeated_ids_with_other_texts(spark):
    """Two texts under one id, each with a near copy; a clean text under the id of a copy."""
    a, b, c = (" ".join(f"{p}{k}" for k in range(60)) for p in "abc")
    rows = [(5, a), (5, b), (7, a + " more"), (3, b + " more"), (9, c), (9, a + " again")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for parts in (1, 3):
        got = ngram_join.jaccard_components(df.repartition(parts), words=5, percent=80, digests=True).collect()
        assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == [(3, 57, 3), (5, 56, 3), (5, 56, 5), (7, 57, 5), (9, 56, 9), (9, 57, 5)]
    kept = corpus_pipeline.drop_near_copies(spark, df, "")
    assert sorted(map(tuple, kept.collect())) == sorted([(5, a), (3, b + " more"), (9, c)])


def test_one_row_of_a_group_stays_whatever_its_id(spark):
    """Rows that share an id, a text, both, or a source; two groups whose smallest id is the same; null ids."""
    t, u = (" ".join(f"{p}{k}" for k in range(60)) for p in "tu")
    rows = [(1, t, "b"), (1, t, "a"), (1, t + " word", "b"), (2, t, "a"), (1, u, "c"), (4, u + " more", "a"), (None, t, "a"), (None, "one of a kind " + u[:40], "a"), (7, None, "a"), (7, "", "a"), (8, " ", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = sorted([(1, t, "a"), (1, u, "c"), (None, "one of a kind " + u[:40], "a"), (7, None, "a"), (7, "", "a"), (8, " ", "a")], key=str)
    for parts in (1, 4):
        assert sorted(map(tuple, corpus_pipeline.drop_near_copies(spark, df.repartition(parts), "").collect()), key=str) == want
    assert corpus_pipeline.drop_near_copies(spark, df.where("false"), "").count() == 0


def test_chunks_encode_like_whole_texts():
    e, rng = ChunkEncoder(default_tokenizer(), 2), random.Random(0)
    texts = ["".join(rng.choice("ab' .,1é\n\t   \x1c!s<|endoftext|> ") for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    texts += [None, "", " ", "  ", " a", "a ", "a\n b", "<|endoftext|> x <|endoftext|>"]
    for t, g in zip(texts, e.documents(pa.array(texts, pa.string())), strict=True):
        assert e.tok.encode(t or "", add_special_tokens=False).ids + [2] == g.tolist(), repr(t)


def tokens(d):
    tok = encoder(default_tokenizer(), 2).tok
    return {i: np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4") for i, t in zip(d.doc_id, d.text)}


def test_archive_round_trip_and_short_access(spark, tmp_path):
    d = pd.read_parquet(f"{SF}/documents.parquet")
    ids = tokens(d)
    where = f"file://{tmp_path}/archive"
    token_archive.write_archive(spark.read.parquet(f"{SF}/documents.parquet"), where)
    got = token_archive.read_archive(spark, where).toPandas().sort_values("doc_id")
    assert (got.start == got.n_tokens.cumsum() - got.n_tokens).all()
    assert all(np.array_equal(np.frombuffer(b, "<u4"), ids[i]) for i, b in zip(got.doc_id, got.ids)) and len(got) == len(d)
    few = token_archive.read_archive(spark, where, [7, 500]).toPandas().set_index("doc_id")
    assert sorted(few.index) == [7, 500] and few.start[500] == got.set_index("doc_id").start[500]
    assert spark.read.parquet(f"{where}/blocks").select("dict_hash").distinct().count() == 1


def test_archive_edges(spark, tmp_path):
    df = spark.createDataFrame([(3, None, "x"), (1, "", "x"), (2, "a b", "x"), (2, "a b", "x"), (None, "c", "x")], "doc_id long, text string, payload string")
    token_archive.write_archive(df, f"file://{tmp_path}/a")
    got = token_archive.read_archive(spark, f"file://{tmp_path}/a").toPandas().sort_values("start")
    assert [None if pd.isna(i) else int(i) for i in got.doc_id] == [None, 1, 2, 2, 3] and got.start.tolist() == [0, 2, 3, 6, 9]
    long = spark.createDataFrame([(k, f"word{k} é, " * 150_000) for k in (5, 6)] + [(5, "b"), (5, "b"), (5, "cc")], "doc_id long, text string")
    token_archive.write_archive(long, f"file://{tmp_path}/c")
    got = token_archive.read_archive(spark, f"file://{tmp_path}/c").toPandas().sort_values("start")
    tok = encoder(default_tokenizer(), 2).tok
    want = [tok.encode(t, add_special_tokens=False).ids + [2] for t in ("b", "b", "cc", "word5 é, " * 150_000, "word6 é, " * 150_000)]
    assert got.doc_id.tolist() == [5, 5, 5, 5, 6] and [np.frombuffer(b, "<u4").tolist() for b in got.ids] == want
    assert token_archive.read_archive(spark, f"file://{tmp_path}/c", [6], with_ids=False).toPandas().start.tolist() == [sum(map(len, want[:4]))]
    assert token_archive.read_archive(spark, f"file://{tmp_path}/c", []).count() == 0
    token_archive.write_archive(df.where("false"), f"file://{tmp_path}/b")
    assert token_archive.read_archive(spark, f"file://{tmp_path}/b").count() == 0


def well_packed(df, most):
    df = df.sort_values(["sequence_id", "offset"])
    g = df.groupby("sequence_id").length
    return bool((g.cumsum() - df.length == df.offset).all() and g.sum().max() <= most)


def test_plans_hold_every_constraint():
    rng = random.Random(3)
    for _ in range(200):
        lengths = [rng.randint(1, 30) for _ in range(rng.randint(1, 200))]
        counts = {n: lengths.count(n) for n in set(lengths)}
        docs, cost = rng.choice([None, 3, 5]), rng.choice([None, 900, 1000])
        plan, n = packing.pack_lengths(counts, 30, docs, cost)
        size = np.repeat(list(counts), list(counts.values()))
        seq, off = packing.place(plan, size, np.concatenate([np.arange(c) for c in counts.values()]))
        df = pd.DataFrame({"sequence_id": seq, "offset": off, "length": size})
        assert df.sequence_id.nunique() == n and well_packed(df, 30)
        assert df.groupby("sequence_id").size().max() <= (docs or 99) and (df.length**2).groupby(df.sequence_id).sum().max() <= (cost or 900)
    with pytest.raises(ValueError):
        packing.pack_lengths({31: 1}, 30)


def test_packing_of_the_tables(spark):
    d = pd.read_parquet(f"{SF}/documents.parquet")
    ids = tokens(d)
    got = packing.op3_packing(spark, SF).toPandas()
    assert well_packed(got, 1024) and got.sequence_id.nunique() <= 1.01 * got.length.sum() / 1024 + 1
    for i, g in got.groupby("doc_id"):
        g = g.sort_values("piece")
        assert g.piece.tolist() == list(range(len(g))) and g.start.tolist() == [s for s, _ in packing.cut(len(ids[i]), 1024)]
        assert [zlib.crc32(ids[i][s : s + n].tobytes()) for s, n in zip(g.start, g.length)] == g.ids_crc32.tolist() and g.length.sum() == len(ids[i])


@pytest.mark.parametrize("ranks", [200_000, 0])
def test_packing_edges(spark, monkeypatch, ranks):
    monkeypatch.setattr(packing, "MAX_RANKS", ranks)
    df = spark.createDataFrame([(1, None, 0), (2, "", 0), (2, "", 0), (3, "word " * 3000, 0), (None, "a", 0)], "doc_id long, text string, length int").withColumns({"shard": F.lit(1), "at": F.lit(2)})
    got = packing.pack(df).toPandas()
    assert well_packed(got, 1024) and (got.doc_id == 2).sum() == 2 and got[got.doc_id == 3].length.tolist()[1:] == [1024] * ((got.doc_id == 3).sum() - 1)
    assert packing.pack(df.where("false")).count() == 0
    assert packing.cut(2050, 1024) == [(0, 2), (2, 1024), (1026, 1024)] and packing.cut(1024, 1024) == [(0, 1024)] and packing.cut(0, 9) == []


# embeddings -----------------------------------------------------------------------------


def brute_links(ids, x, labels, least=0.98):
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = (x @ x.T >= least) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(hit, False)
    return dict(zip(ids, hit.sum(1))), roots(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(hit))])


def cluster_vectors(seed, n):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(n // 12, 16))
    x = centre[rng.integers(0, len(centre), n)] + rng.normal(size=(n, 16)) * rng.choice([0.02, 0.1, 0.4], (n, 1))
    return x, rng.integers(0, 2, n)


@pytest.mark.parametrize(("cell", "group", "centres"), [(1500, 4096, 4096), (60, 4096, 4096), (200, 150, 4096), (40, 4096, 3)])
def test_embedding_links(spark, monkeypatch, cell, group, centres):
    """One group a label; many cells; cells cut into blocks; so few centres that their cells are split again."""
    for name, value in (("CELL", cell), ("MAX_GROUP", group), ("MAX_CENTRES", centres), ("DEAL", 500)):
        monkeypatch.setattr(embedding_dedup, name, value)
    x, labels = cluster_vectors(cell, 1200)
    df = spark.createDataFrame([(k, x[k].tolist(), int(labels[k])) for k in range(len(x))], "vec_id long, embedding array<double>, label int")
    got = embedding_dedup.embedding_components(df).toPandas().set_index("vec_id")
    links, component = brute_links(list(range(len(x))), x, labels)
    assert got.n_links.sum() >= 0.99 * sum(links.values()) and all(got.n_links[k] <= links[k] for k in links)
    assert (got.component_id == pd.Series(component)).mean() > 0.99 and (got.kept == (got.index == got.component_id)).all()
    every = [k for k in links if k % 100 == 0]
    assert got.audit_recall.iloc[0] == pytest.approx(sum(got.n_links[k] for k in every) / sum(links[k] for k in every))


def test_links_count_for_both_ends(spark, monkeypatch):
    """With a search that misses much, a link still counts for both its ends, and the recall that is told is the real one."""
    monkeypatch.setattr(embedding_dedup, "WIDTHS", (1,))
    monkeypatch.setattr(embedding_dedup, "LEAST_RECALL", 0.0)
    real = embedding_dedup.near_pairs
    monkeypatch.setattr(embedding_dedup, "near_pairs", lambda *a: tuple(v[::2] for v in real(*a)))
    x, labels = cluster_vectors(7, 900)
    found = []
    monkeypatch.setattr(embedding_dedup, "lowest_labels", lambda n, a, b: found.append(len(a)) or np.arange(n))
    df = spark.createDataFrame([(k, x[k].tolist(), int(labels[k])) for k in range(len(x))], "vec_id long, embedding array<double>, label int")
    got = embedding_dedup.embedding_components(df).toPandas().set_index("vec_id")
    links, _ = brute_links(list(range(len(x))), x, labels)
    assert got.n_links.sum() % 2 == 0 and all(got.n_links[k] <= links[k] for k in links)


@pytest.mark.parametrize("queries", [2048, 3])
def test_a_low_recall_is_never_returned(spark, monkeypatch, queries):
    """A search that finds next to nothing: groups are finished exactly. Copies whose smallest id isn't a query's are asked as well."""
    monkeypatch.setattr(embedding_dedup, "WIDTHS", (1, 2))
    monkeypatch.setattr(embedding_dedup, "near_pairs", lambda *a: (np.zeros(0, np.int64),) * 2)
    for name, value in (("CELL", 60), ("MAX_GROUP", 100), ("AUDIT_QUERIES", queries), ("AUDIT_VECTORS", 70)):
        monkeypatch.setattr(embedding_dedup, name, value)
    x, labels = cluster_vectors(5, 600)
    x = np.concatenate([x, x[:1]])
    labels = np.append(labels, labels[0])
    ids = [7 + 100 * k + 1 for k in range(len(x) - 1)] + [500_000]  # one query alone, a copy of the first
    df = spark.createDataFrame([(i, v.tolist(), int(k)) for i, v, k in zip(ids, x, labels, strict=True)], "vec_id long, embedding array<double>, label int")
    got = embedding_dedup.embedding_components(df).toPandas().set_index("vec_id")
    links, component = brute_links(ids, x, labels)
    assert links[500_000] > 1 and got.audit_recall.iloc[0] == 1.0
    assert got.n_links.to_dict() == links and got.component_id.to_dict() == dict(component)


def test_all_pairs():
    x = cluster_vectors(3, 300)[0]
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    a, b = flat_graph.all_pairs(x, None, 0.98)
    assert set(zip(a.tolist(), b.tolist(), strict=True)) == {(i, j) for i, j in np.argwhere(x @ x.T >= 0.98).tolist() if i < j}
    a, b = flat_graph.all_pairs(x[:50], x[50:], 0.98)
    assert set(zip(a.tolist(), b.tolist(), strict=True)) == {(i, j) for i, j in np.argwhere(x[:50] @ x[50:].T >= 0.98).tolist()}


def test_embedding_links_of_large_groups(spark):
    """Thousands of distinct near copies in one label, and looser ones that straddle cells."""
    rng = np.random.default_rng(3)
    far = rng.normal(size=(3000, 64))
    near = rng.normal(size=64) + 0.07 * rng.normal(size=(3000, 64))
    loose = np.repeat(rng.normal(size=(200, 64)), 4, axis=0) + 0.09 * rng.normal(size=(800, 64))
    x = np.concatenate([far, near, loose])
    df = spark.createDataFrame([(k, v.tolist(), 0) for k, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = embedding_dedup.embedding_components(df).toPandas().set_index("vec_id").sort_index()
    links, component = brute_links(list(range(len(x))), x, np.zeros(len(x)))
    assert sum(links.values()) > 5_000_000
    assert got.n_links.sum() >= 0.99 * sum(links.values()) and (got.component_id == pd.Series(component)).mean() > 0.999


def test_reach_covers_the_radius():
    rng = np.random.default_rng(4)
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    c, x = unit(rng.normal(size=(30, 8))), unit(rng.normal(size=(3000, 8)))
    home, inside = embedding_dedup.reach(x, c, 0.2)
    other = unit(x + unit(rng.normal(size=x.shape)) * rng.uniform(0, 0.19, (len(x), 1)))
    ok = np.linalg.norm(other - x, axis=1) <= 0.2
    there = embedding_dedup.reach(other, c, 0.2)[0]
    assert (there != home)[ok].sum() > 100 and inside[np.arange(len(x)), there][ok].all() and not inside.all()


@pytest.mark.parametrize("dim", [16, 300])
def test_graph_search_recall(dim):
    """It finds the links of 3,000 vectors by scoring a small part of the pairs."""
    rng = np.random.default_rng(dim)
    x = rng.normal(size=(250, dim))[rng.integers(0, 250, 3000)] + rng.normal(size=(3000, dim)) * rng.choice([0.02, 0.1, 0.4], (3000, 1))
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    g = flat_graph.FlatGraph(x)
    true = x @ x.T >= 0.98
    q, node = g.range_search(x, 0.98, np.arange(len(x)))
    assert true[q, node].all() and len(q) >= 0.98 * true.sum() and g.scored < 0.2 * len(x) ** 2
    a, b = flat_graph.near_pairs(x, None, 0.98)
    assert (a < b).all() and len(a) >= 0.98 * (true.sum() - len(x)) / 2
    a, b = flat_graph.near_pairs(x[:1000], x[1000:], 0.98)
    assert true[a, 1000 + b].all() and len(a) >= 0.95 * true[:1000, 1000:].sum()


def test_labels_of_links():
    rng = np.random.default_rng(2)
    for _ in range(50):
        n, m = rng.integers(1, 60), rng.integers(0, 60)
        a, b = rng.integers(0, n, m), rng.integers(0, n, m)
        assert flat_graph.lowest_labels(n, a, b).tolist() == list(roots(range(n), zip(a.tolist(), b.tolist())).values())


def test_embedding_edges(spark):
    v, nan, inf = [1.0, 2.0], float("nan"), float("inf")
    rows = [(1, v, 0), (2, v, 0), (2, v, 0), (3, [2.0, 4.0], 0), (4, v, 1), (5, v, None), (6, None, 0), (7, [0.0, 0.0], 0), (8, [1.0, None], 0), (9, [nan, 1.0], 0), (10, [inf, 1.0], 0), (11, [], 0), (12, [1.0, 2.0, 0.0], 0), (None, v, 0), (13, [-1.0, 2.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns({"part": F.lit(1), "copies": F.lit(1)})
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in embedding_dedup.embedding_components(df).collect()), key=str)
    want = [(1, 3, 1), (2, 3, 1), (2, 3, 1), (3, 3, 1), (None, 0, None)] + [(k, 0, k) for k in (4, 5, 6, 7, 8, 9, 10, 11, 12, 13)]
    assert got == sorted(want, key=str)
    assert embedding_dedup.embedding_components(df.where("false")).count() == 0


# pipeline -------------------------------------------------------------------------------


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    cols, sizes = docs.columns, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, SF).cache()
        assert docs.columns == cols and docs.dtypes == before.dtypes
        sizes.append(docs.count())
        if stage is corpus_pipeline.drop_near_copies:
            d = before.toPandas()
            want = {i for i, (_, r) in brute_jaccard(zip(d.doc_id, d.text), 5, 80).items() if i == r}
            assert {r.doc_id for r in docs.select("doc_id").collect()} == want
    assert sizes[0] > sizes[1] == sizes[2] > sizes[3]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF).toPandas()
    assert well_packed(last, 1024) and set(last.doc_id) == {r.doc_id for r in docs.select("doc_id").collect()}


def test_pipeline_keeps_distinct_texts_of_one_id(spark):
    t, u = (" ".join(f"{p}{k}" for k in range(60)) for p in "tu")
    ddl = "doc_id long, text string, lang string, source string, n_chars long"
    df = spark.createDataFrame([(1, t, "en", "a", 1), (2, t, "en", "a", 1), (2, u, "en", "a", 1)], ddl).withColumns({c: F.lit(1) for c in ("a", "b", "k", "row", "times", "copy", "id")})
    got = corpus_pipeline.drop_near_copies(spark, df, "")
    assert sorted((r.doc_id, r.text) for r in got.collect()) == [(1, t), (2, u)] and got.columns == df.columns


def test_pipeline_repeats_by_source(spark):
    """One id in two sources: each takes it as often as its own share asks."""
    w = "w " * 10
    rows = [(1, w, "a", 1), (1, w, "b", 1)] + [(k, w, "b", 1) for k in range(2, 12)] + [(50, None, "a", 1), (51, " ", "b", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, times long").withColumns({c: F.lit("mine") for c in ("k", "copy", "whole", "prefix", "edge")})
    got = corpus_pipeline.mix_sources(spark, df, "").collect()
    assert sum(r.doc_id == 1 and r.source == "a" for r in got) == 3 and sum(r.doc_id == 1 and r.source == "b" for r in got) < 2
    assert {r.copy for r in got} == {"mine"} and all(r.text == w for r in got)
    size, taken = F.col("size"), F.col("taken")
    by_mix = mixing.mix(df).where("size > 0").groupBy("doc_id", "source_size").agg(F.sum((taken / size).cast("int")).alias("n")).where("n > 0")
    assert sorted(r.n for r in by_mix.collect()) == sorted(pd.DataFrame([(r.doc_id, r.source) for r in got]).value_counts().tolist())


def test_pipeline_on_odd_rows(spark):
    t = " ".join(f"word{k} goes." for k in range(60))
    rows = [(1, t, "en", "a", 1), (1, t, "en", "a", 1), (2, None, None, None, None), (3, "", "en", "b", 0), (4, t + " More.", "en", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, "").cache()
    assert [r.doc_id for r in docs.collect()] == [1]
    empty = docs.where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "").count() == 0
