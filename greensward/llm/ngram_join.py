"""N-gram Jaccard join: exact prefix filtering, then prefix-tree joins within bounded groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from greensward.llm.memory import give_back, text_batches
from greensward.llm.prefix_trie import linked_forest, linked_to
from greensward.llm.shingles import Shingler, set_key
from greensward.operators.graph import connected_components
from greensward.plans.scratch import Scratch

#: Shingles that one group of the count holds, the least number of groups, and shingles that a task deals out at a time.
GROUP_SHINGLES, MIN_GROUPS, FLUSH_SHINGLES = 8 << 20, 64, 1 << 20
#: Sets in a block of a large candidate group, sets held against a hub at a time, and rounds of that before blocks meet.
BLOCK_SETS, HUB_SETS, HUB_ROUNDS = 64, 512, 3
#: Shingles in more sets than this are joined by broadcast: so many at least, and as many more as keeps their number below ``HOT_SHINGLES``.
HOT_SETS, HOT_SHINGLES = 1000, 200_000
#: Bits of the hash in a shingle's number; the bits above hold its place by document frequency.
HASH_BITS = 54
#: In place of a digest: a shingle that several sets of one task have.
MANY = -(1 << 63)

SIG = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])
SIG_DDL = "doc_id bigint, n_shingles bigint, a bigint, b bigint"


def least_overlap(n: Column, percent: int) -> Column:
    """The least overlap with a set of ``n`` that a set of any size needs to be linked."""
    return F.ceil(n * percent / F.lit(100.0) - 1e-9)


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id, n_shingles, a, b``: size and 128-bit digest of each document's set."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(words)
        for batch in batches:
            rows = []
            for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                s = shingle((t.as_py() or "").encode())
                rows.append((i, len(s), *set_key(s)))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], schema=SIG)
        give_back()

    return docs.select("doc_id", "text").mapInArrow(sign, SIG_DDL)


def shared_counts(docs: DataFrame, words: int, groups: int) -> DataFrame:
    """``(a, shared)``: how many shingles of a set are in another distinct set too.

    A task takes ``FLUSH_SHINGLES`` shingles at a time. Those that several of its
    sets have are counted for these sets at once and sent on a single time, as
    found in many; the others go with half the digest of their set. They are
    dealt out to ``groups`` groups by their top bits, as packed arrays: the next
    32 bits of each, in the order of the sets, which come with a count. A group
    sorts its shingles and counts those that two digests share or that many
    have. So a shingle that all documents hold comes to its group once for each
    flush, not for each document. Shortened hashes can only raise a count.
    """
    bits = max(1, (groups - 1).bit_length())
    fields = [("grp", pa.int32()), ("flush", pa.int64()), ("docs", pa.binary()), ("counts", pa.binary()), ("rest", pa.binary())]
    schema, ddl = pa.schema(fields), "grp int, flush bigint, docs binary, counts binary, rest binary"

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, seen, number = Shingler(words), set(), TaskContext.get().partitionId() << 32
        sets, keys, held = [], [], 0

        def flush(number: int) -> pa.RecordBatch:
            h = np.concatenate(sets)
            by = np.argsort(h, kind="stable")
            h, doc = h[by], np.repeat(np.arange(len(sets)), [len(s) for s in sets])[by]
            same = h[1:] == h[:-1]
            shared = np.concatenate([same, [False]]) | np.concatenate([[False], same])
            local = np.bincount(doc[shared], minlength=len(sets))
            once = np.concatenate([[True], ~same])
            doc[shared] = len(sets)
            h, doc = h[once], doc[once]
            grp = (h >> np.uint64(64 - bits)).astype(np.int64)
            by = np.lexsort((doc, grp))
            grp, doc, rest = grp[by], doc[by], (h[by] >> np.uint64(32 - bits)).astype(np.uint32)
            key = np.append(np.array(keys, np.int64), MANY)
            n = np.flatnonzero(local)
            rows = [(int(grp[0]), number, key[n].tobytes(), local[n].astype(np.uint32).tobytes(), b"")]
            cut = np.flatnonzero(np.concatenate([[True], grp[1:] != grp[:-1], [True]]))
            for s, e in zip(cut[:-1], cut[1:], strict=True):
                run = np.flatnonzero(np.concatenate([[True], doc[s + 1 : e] != doc[s : e - 1], [True]]))
                rows.append((int(grp[s]), number, key[doc[s + run[:-1]]].tobytes(), np.diff(run).astype(np.uint32).tobytes(), rest[s:e].tobytes()))
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

        for batch in batches:
            for t in batch.column("text"):
                s = shingle((t.as_py() or "").encode())
                if not len(s) or (k := set_key(s)[0]) in seen:
                    continue
                seen.add(k)
                sets.append(s)
                keys.append(k)
                held += len(s)
                if held >= FLUSH_SHINGLES:
                    yield flush(number)
                    sets, keys, held, number = [], [], 0, number + 1
        if sets:
            yield flush(number)
        sets.clear()
        give_back()

    def count(table: pa.Table) -> pa.Table:
        out = [(np.zeros(0, np.int64),) * 3]
        rows = [(f, np.frombuffer(d, np.int64), np.frombuffer(c, np.uint32), np.frombuffer(r, np.uint32)) for f, d, c, r in zip(*(table.column(x).to_pylist() for x in ("flush", "docs", "counts", "rest")), strict=True)]
        out += [(d, np.full(len(d), f), c.astype(np.int64)) for f, d, c, r in rows if not len(r)]
        rows = [r for r in rows if len(r[3])]
        if rows:
            doc, each, rest = (np.concatenate([r[i] for r in rows]) for i in (1, 2, 3))
            flush = np.repeat([r[0] for r in rows], [len(r[1]) for r in rows])
            key, code = np.unique(doc, return_inverse=True)  # MANY comes first
            entry = np.repeat(np.arange(len(doc)), each)
            both = (rest.astype(np.uint64) << np.uint64(32)) | code[entry].astype(np.uint64)
            by = np.argsort(both, kind="stable")
            both, entry = both[by], entry[by]
            token = both >> np.uint64(32)
            start = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
            end = np.append(start[1:], len(token)) - 1
            several = both[start] != both[end]
            if key[0] == MANY:
                several |= (both[start] & np.uint64(0xFFFFFFFF)) == 0
            n = np.bincount(entry[np.repeat(several, end - start + 1)], minlength=len(doc))
            n[doc == MANY] = 0
            out.append((doc[n > 0], flush[n > 0], n[n > 0]))
        a, flush, n = (np.concatenate(c) for c in zip(*out, strict=True))
        give_back()
        return pa.table({"a": pa.array(a, pa.int64()), "flush": pa.array(flush, pa.int64()), "n": pa.array(n, pa.int64())})

    counted = docs.select("text").mapInArrow(deal, ddl).groupBy("grp").applyInArrow(count, "a bigint, flush bigint, n bigint")
    # copies of a set in other flushes have the same count
    return counted.groupBy("a", "flush").agg(F.sum("n").alias("n")).groupBy("a").agg(F.max("n").alias("shared"))


def set_arrays(docs: DataFrame, words: int) -> DataFrame:
    """``a, b, n, toks`` with the digest and the whole set of each document."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64()), ("toks", pa.list_(pa.int64()))])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(words)
        for batch in batches:
            sets = [shingle((t.as_py() or "").encode()) for t in batch.column("text")]
            a, b = zip(*map(set_key, sets), strict=True) if sets else ((), ())
            sets = [s.view(np.int64) for s in sets]
            n = [len(s) for s in sets]
            flat = np.concatenate(sets) if sets else np.zeros(0, np.int64)
            toks = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(n)]).astype(np.int32), pa.array(flat, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64()), toks], schema=schema)

    return docs.select("text").mapInArrow(build, "a bigint, b bigint, n bigint, toks array<bigint>")


def join_hot(rows: DataFrame, table: DataFrame, key: str, count: str, most: int, scratch: Scratch) -> DataFrame:
    """``rows`` joined to a written ``table``, whose keys of over ``most`` rows are broadcast and so split like the rows themselves."""
    hot = scratch.put(table.where(F.col(count) > most), "hot")
    if hot.isEmpty():
        return rows.join(table, key)
    few = scratch.small(hot)
    rest = rows.join(few.select(key), key, "left_anti").join(table.where(F.col(count) <= most), key)
    return rows.join(few, key).select(rest.columns).unionByName(rest)


def ordered_sets(sets: DataFrame, most: int, scratch: Scratch) -> DataFrame:
    """``id, n, toks, centre``: each set's shingles that another set holds too, as numbers in one global order.

    A number is the shingle's document frequency (an eighth of a power of two)
    above its hash, so numbers ascend from rare to common in every set alike.
    ``centre`` is the mean frequency of a set's shingles: high for the original
    of many copies.
    """
    each = sets.select(F.col("doc_id").alias("id"), "n", F.explode("toks").alias("tok"))
    df = scratch.put(each.groupBy("tok").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "frequencies")
    level = F.least(F.floor(8 * F.log2("df")), F.lit((1 << (63 - HASH_BITS)) - 1))
    number = F.shiftleft(level, HASH_BITS).bitwiseOR(F.col("tok").bitwiseAND((1 << HASH_BITS) - 1))
    all_ = join_hot(each, df, "tok", "df", most, scratch).groupBy("id", "n")
    return all_.agg(F.array_sort(F.collect_list(number)).alias("toks"), (F.sum("df") / F.col("n")).alias("centre"))


def candidate_prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """``tok, id``: the shingles of each set's prefix, the rarest ones.

    Two linked sets share one among the first ``n - least_overlap(n) + 1`` of
    each in the global order; those in no other set stand before all others and
    only shorten the prefix.
    """
    prefix = F.col("n") - least_overlap(F.col("n"), percent) + 1
    left = (prefix - (F.col("n") - F.size("toks"))).cast("int")
    return sets.where(left > 0).select(F.explode(F.slice("toks", 1, F.greatest(left, F.lit(1)))).alias("tok"), "id")


def star(rows: DataFrame, key: str, most: int, scratch: Scratch) -> DataFrame:
    """Edges from every ``id`` to the smallest one with its ``key``; with none for keys of one id."""
    low = rows.groupBy(key).agg(F.min("id").alias("dst"), F.max("id").alias("top"), F.count(F.lit(1)).alias("k")).where("dst <> top").drop("top")
    near = join_hot(rows, scratch.put(low, "lowest"), key, "k", most, scratch)
    return near.where("id <> dst").select(F.col("id").alias("src"), "dst").distinct()


def links_in_groups(sets: DataFrame, prefixes: DataFrame, groups: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Links ``src, dst`` that join up the same components as all links within each candidate group do.

    ``groups`` has id and component; no link leaves a component. A group of up
    to ``BLOCK_SETS`` sets goes to one task. In a larger one every set is first
    held against the hub, the most central set, in tries of ``HUB_SETS`` sets,
    and the sets linked to it become a layer; the rest does so again. What is in
    one layer is joined already. Sets of different layers, and the rest among
    itself, then meet by the prefix shingles that they share: a shingle whose
    sets are all in one layer brings nothing new, and shingles with the same
    sets count once. Where that would ship more sets than meeting in the whole
    group does (few sets left of one dense group), they meet there instead.
    Either way a group of over ``BLOCK_SETS`` sets is cut into blocks by size
    and hash, and each pair of blocks whose sizes allow a link is a group.
    """
    parts = groups.groupBy("component").agg(F.count(F.lit(1)).alias("m"))
    parts = scratch.small(scratch.put(parts, "parts"))
    m = scratch.put(groups.join(parts, "component").join(sets, "id").select("component", "m", "id", "centre", "n", "toks"), "members")
    alone = [F.lit("").alias("i"), F.lit("").alias("j"), "id", "n"]
    edges = _trie_join(m.where(F.col("m") <= BLOCK_SETS).select(F.col("component").alias("c"), *alone, F.lit(-1).alias("layer"), "toks"), percent)
    big = m.where(F.col("m") > BLOCK_SETS)
    if big.isEmpty():
        return edges
    big = scratch.put(big.withColumn("layer", F.lit(-1)), "large")
    for k in range(HUB_ROUNDS):
        found = scratch.small(scratch.put(_hub_links(big.where("layer = -1"), percent, scratch), "hub_links"))
        edges = edges.unionByName(found.where("id <> hub").select(F.col("id").alias("src"), F.col("hub").alias("dst")))
        layer = F.when(F.col("hub").isNotNull(), F.lit(k)).otherwise(F.col("layer"))
        big = scratch.put(big.join(found, "id", "left").withColumn("layer", layer).drop("hub"), f"layer{k}")
    name = F.when(F.col("layer") < 0, F.col("id")).otherwise(-1 - F.col("layer"))
    held = prefixes.join(big.select("id", "component", "layer"), "id").withColumn("name", name)
    by_tok = held.groupBy("tok", "component").agg(F.count(F.lit(1)).alias("k"), F.min("name").alias("lo"), F.max("name").alias("hi"), F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y"))
    toks = scratch.put(by_tok.where("lo <> hi").groupBy("component", "k", "x", "y").agg(F.min("tok").alias("tok")), "tokens")
    half = BLOCK_SETS / 2
    cost = big.groupBy("component").agg((F.count(F.lit(1)) * F.count_if(F.col("layer") < 0) / half).alias("whole"))
    cost = cost.join(toks.groupBy("component").agg(F.sum(F.col("k") * F.ceil(F.col("k") / half)).alias("tokens")), "component")
    cost = scratch.put(cost.select("component", (F.col("tokens") <= F.col("whole")).alias("by_token"), (F.col("whole") > 0).alias("some")), "costs")
    few = scratch.small(cost)
    toks = toks.join(few.where("by_token"), "component").select("tok", "k")
    meet = join_hot(prefixes, scratch.put(toks, "meeting"), "tok", "k", HOT_SETS, scratch).join(big.select("id", "n", "layer", "toks"), "id")
    meet = scratch.put(meet.select(F.col("tok").alias("component"), "k", "id", "n", "layer", "toks"), "meet")
    edges = edges.unionByName(_trie_join(meet.where(F.col("k") <= BLOCK_SETS).select(F.col("component").alias("c"), *alone, "layer", "toks"), percent))
    dense = big.join(few.where("not by_token"), "component").select("component", "id", "n", "layer", "toks")
    for large in (meet.where(F.col("k") > BLOCK_SETS).drop("k"), dense):
        if not large.isEmpty():
            edges = edges.unionByName(_trie_join(_block_pairs(scratch.put(large, "cut"), percent, scratch), percent))
    return edges


def _hub_links(rest: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """``id, hub``: the sets of each component that are linked with its hub, and the hub itself."""
    best = rest.groupBy("component").agg(F.max_by("id", F.struct("centre", "id")).alias("hub"), F.ceil(F.count(F.lit(1)) / HUB_SETS).cast("int").alias("deals"))
    best = scratch.small(scratch.put(best, "hubs"))
    rest = rest.join(best, "component")
    deals = F.when(F.col("id") == F.col("hub"), F.sequence(F.lit(0), F.col("deals") - 1)).otherwise(F.array(F.pmod(F.xxhash64("id"), F.col("deals")).cast("int")))
    dealt = rest.select("component", F.explode(deals).alias("deal"), "id", "hub", "n", "toks")

    def probe(table: pa.Table) -> pa.Table:
        ids, sizes, sets = _sets(table)
        hub = table.column("hub")[0].as_py()
        at, others = np.flatnonzero(ids == hub)[0], np.flatnonzero(ids != hub)
        near = linked_to(sets[at], int(sizes[at]), [sets[i] for i in others], sizes[others], percent)
        got = np.append(ids[others[near]], hub)
        del sets
        give_back()
        return pa.table({"id": pa.array(got, pa.int64()), "hub": pa.array(np.full(len(got), hub), pa.int64())})

    return dealt.groupBy("component", "deal").applyInArrow(probe, "id bigint, hub bigint").distinct()


def _block_pairs(big: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Deal the sets of large groups out to pairs of blocks."""
    per = big.groupBy("component", "layer").agg(F.count(F.lit(1)).alias("k"))
    per = scratch.small(scratch.put(per, "layers"))
    band = F.floor(F.log("n") / float(np.log(100 / percent)))
    part = F.pmod(F.xxhash64("id"), F.ceil(F.col("k") / (BLOCK_SETS / 2)))
    name = F.concat_ws("/", F.format_string("%02d", "layer"), band, part)
    big = big.join(per, ["component", "layer"]).withColumn("blk", name)
    blocks = big.groupBy("component", "layer", "blk").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    blocks = scratch.put(blocks, "blocks")
    a, b = blocks.alias("a"), blocks.alias("b")
    apart = F.col("a.layer") != F.col("b.layer")
    rest = (F.col("a.layer") == -1) & (F.col("b.layer") == -1)
    sizes = (100 * F.col("a.hi") >= percent * F.col("b.lo")) & (100 * F.col("b.hi") >= percent * F.col("a.lo"))
    meet = a.join(b, F.col("a.component") == F.col("b.component")).where((F.col("a.blk") <= F.col("b.blk")) & (apart | rest) & sizes)
    meet = meet.select(F.col("a.component").alias("c"), F.col("a.blk").alias("i"), F.col("b.blk").alias("j"))
    goes = meet.select("c", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("blk"))
    goes = scratch.small(scratch.put(goes, "pairs"))
    return big.join(goes, (F.col("component") == F.col("c")) & (big["blk"] == goes["blk"])).select("c", "i", "j", "id", "n", "layer", "toks")


def _sets(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Ids, sizes and tokens of a group's sets in the order of their ids."""
    table = table.combine_chunks()
    order = np.argsort(ids := table.column("id").to_numpy(), kind="stable")
    toks = table.column("toks").combine_chunks()
    flat, off = toks.flatten().to_numpy(zero_copy_only=False), np.asarray(toks.offsets) - toks.offsets[0].as_py()
    return ids[order], table.column("n").to_numpy()[order], [flat[off[i] : off[i + 1]] for i in order]


def _trie_join(rows: DataFrame, percent: int) -> DataFrame:
    def join(table: pa.Table) -> pa.Table:
        ids, sizes, sets = _sets(table)
        layers = table.column("layer").to_numpy()[np.argsort(table.column("id").to_numpy(), kind="stable")]
        pairs = linked_forest(sets, sizes, layers, percent)
        del sets
        give_back()
        return pa.table({"src": pa.array([ids[i] for i, _ in pairs], pa.int64()), "dst": pa.array([ids[j] for _, j in pairs], pa.int64())})

    return rows.groupBy("c", "i", "j").applyInArrow(join, "src bigint, dst bigint")


def jaccard_components(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80, digests: bool = False) -> DataFrame:
    """``doc_id, n_shingles, component_id``, a row for each row of ``docs``; with ``digests`` also its set's ``a, b``.

    Documents are linked when the Jaccard similarity of their sets of
    ``words``-word shingles is at least ``percent`` / 100; ``component_id`` is
    the smallest doc_id reachable over links. Exact, up to 64-bit hashes of
    shingles: 1. equal sets become one class; 2. a count of the shingles that
    are in two classes or more drops the classes with too few for any link;
    3. the prefixes of the others, rarest shingles first, connect candidates;
    4. each connected group is joined by prefix tries (``links_in_groups``);
    5. links and classes give the components.

    Texts without a word, null or not, have no shingles and no links; nor have
    rows whose doc_id is null (their component is null). Rows that repeat a
    doc_id are each judged by their own text: classes have numbers of their own,
    and doc_ids only name the components. An empty table gives an empty
    result; other columns are ignored, whatever their names.
    """
    text_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "jaccard")
    docs = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    sig = scratch.put(signatures(docs, words), "signatures")
    classes = sig.where("n_shingles > 0 and doc_id is not null").groupBy("a", "b", "n_shingles")
    classes = classes.agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    classes = scratch.put(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    total = classes.agg(F.sum("n_shingles")).first()[0] or 0
    shared = shared_counts(docs, words, max(MIN_GROUPS, -(-total // GROUP_SHINGLES)))
    some = classes.join(shared, "a").where(F.col("shared") >= least_overlap(F.col("n_shingles"), percent)).select("id", "first", classes["a"], "b")
    some = scratch.small(scratch.put(some, "candidates"))
    arrays = set_arrays(docs.join(some, F.col("doc_id") == F.col("first"), "left_semi"), words)
    sets = arrays.join(some, ["a", "b"]).select(F.col("id").alias("doc_id"), "n", "toks").dropDuplicates(["doc_id"])
    sets = scratch.put(sets, "sets")
    most = max(HOT_SETS, total // HOT_SHINGLES)
    sets = scratch.put(ordered_sets(sets, most, scratch), "ordered")
    prefixes = scratch.put(candidate_prefixes(sets, percent), "prefixes")
    groups = connected_components(star(prefixes, "tok", most, scratch), scratch=scratch)
    links = scratch.put(links_in_groups(sets, prefixes, groups, percent, scratch), "links")
    found = connected_components(links, scratch=scratch)
    named = scratch.put(classes.join(found, "id", "left").where("copies > 1 or component is not null"), "linked")
    lowest = named.where("component is not null").groupBy("component").agg(F.min("first").alias("low"))
    named = named.join(lowest, "component", "left")
    named = named.select(F.col("a").alias("ka"), F.col("b").alias("kb"), F.coalesce("low", "first").alias("root"))
    named = scratch.put(named, "named")
    scratch.keep(sig, named)
    named = scratch.small(named)
    out = sig.join(named, (F.col("a") == F.col("ka")) & (F.col("b") == F.col("kb")) & (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), "left")
    return out.select("doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id"), *(["a", "b"] if digests else []))


def op1_ngram_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"), words=4, percent=85)
