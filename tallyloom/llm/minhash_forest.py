"""Near duplicates by an LSH forest: sorted signature orders with longest-common-prefix neighbours.

1. Texts with the same shingle set form a class; only classes are compared.
2. Each of ``TREES`` orders sorts the classes by ``DEPTH`` of their minimum hashes. The rows are
   dealt by key range, so a crowded region spans as many tasks as it needs. Candidates are rows
   near each other that share a prefix of at least ``LEAST_DEPTH`` hashes. In a thin region these
   are all rows of the prefix; in a crowded one the neighbours are those with the longest common
   prefix, so the depth adapts to the region.
   Rows alone in their prefix, or there with rows of their own component only, are left out before
   the orders are sorted: they are in no pair.
   Rows carry half a byte of each hash; neighbours that agree too rarely (five standard
   deviations below the threshold) are no candidates.
3. The orders are read in turns. First the next row of each order is a candidate, and each class is
   checked against its most alike ones; the confirmed links give components. Then the next
   ``NEIGHBOURS`` rows are candidates if they belong to another component, and all of these are
   checked. This is repeated with the hashes dealt to new orders until a turn finds no new link.
   Prefixes of the last turn with more rows than that, and more than one component, are then
   compared completely: all pairs of rows of different components, block by block.
4. All checks are made on the full sets. Components come from alternating star contractions of the
   confirmed links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm import tokens
from tallyloom.sources.staging import forget, stage

SHINGLE = 4
TREES, DEPTH, LEAST_DEPTH, NEIGHBOURS = 16, 8, 3, 10
HASHES = TREES * DEPTH
SIMILAR = 80  # per cent of the union
#: agreeing half bytes of two signatures below which a pair is not checked
AGREE = int(0.8125 * HASHES - 5 * (0.8125 * 0.1875 * HASHES) ** 0.5)
BLOCK_ROWS, BLOCK_SHINGLES = 512, 500_000  # of a block of a crowded prefix
COLUMNS = 4096  # shingles of a block counted at once
FEW_IDS = 2_000_000  # ids that may be broadcast (32 MB)
LINKS, FEW_TASKS = 100_000, 12  # links of a task of the component search, and its tasks at least

_FACTORS = (tokens.mix(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)).astype(np.uint32)
_SHIFTS = (tokens.mix(np.arange(1, HASHES + 1, dtype=np.uint64) + np.uint64(1 << 40)) >> np.uint64(32)).astype(np.uint32)


def _sets(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for at, end, buf, offsets in tokens.blocks(texts):
        buf = tokens.LOWER[buf]
        starts, ends, first = tokens.spans(buf, offsets, tokens.NOT_SPACE)
        values, bounds = tokens.shingles(tokens.word_hashes(buf, starts, ends), first, SHINGLE)
        yield at, end, *tokens.distinct(values, bounds)


def _signatures(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Minimum hashes (uint32) of every non-empty set; rows of empty sets are 0."""
    out = np.zeros((len(bounds) - 1, HASHES), np.uint32)
    filled = np.flatnonzero(np.diff(bounds))
    if len(filled):
        x = (values >> np.uint64(32)).astype(np.uint32)
        low = values.astype(np.uint32)
        for j in range(HASHES):
            y = (x ^ (low >> np.uint32(j % 16))) * _FACTORS[j] + _SHIFTS[j]
            y ^= y >> np.uint32(15)
            y *= np.uint32(0x2C1B3C6D)
            out[filled, j] = np.minimum.reduceat(y, bounds[:-1][filled])
    return out


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_high and set_low (equal for equal sets), signature, short (half a byte per hash)."""

    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for at, end, values, bounds in _sets(texts):
                filled = np.flatnonzero(np.diff(bounds))
                keys = np.zeros((2, end - at), np.uint64)
                if len(filled):
                    for i, salt in enumerate((0x1234567, 0x89ABCDEF01)):
                        keys[i, filled] = np.add.reduceat(tokens.mix(values ^ np.uint64(salt)), bounds[:-1][filled])
                # big-endian, so that bytes sort like the numbers
                signature = _signatures(values, bounds)
                half = (signature & 15).astype(np.uint8)
                half = half[:, ::2] << 4 | half[:, 1::2]
                columns = [(signature.astype(">u4").tobytes(), 4 * HASHES), (half.tobytes(), HASHES // 2)]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(at, end - at),
                        pa.array(np.diff(bounds)),
                        pa.array(keys[0].view(np.int64)),
                        pa.array(keys[1].view(np.int64)),
                        *(pa.array([raw[i * w : (i + 1) * w] for i in range(end - at)], pa.binary()) for raw, w in columns),
                    ],
                    names=["doc_id", "n_shingles", "set_high", "set_low", "signature", "short"],
                )

    schema = "doc_id long, n_shingles long, set_high long, set_low long, signature binary, short binary"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def _ordered_keys(classes: DataFrame, turn: int, depth: int, *columns: str, trees: str | None = None) -> DataFrame:
    """tree, key (the first ``depth`` hashes of that order) and ``columns`` of each class and order
    (of those in its column ``trees``, if named). Every ``turn`` deals the hashes to the orders anew."""
    deal = 2 * turn * 13 + 1  # odd, so that all hashes are used
    pieces = [f"substring(signature, (tree * {DEPTH} + {i}) * {deal} % {HASHES} * 4 + 1, 4)" for i in range(depth)]
    tree = F.explode(F.col(trees) if trees else F.sequence(F.lit(0), F.lit(TREES - 1)))
    rows = classes.select("signature", *columns, tree.alias("tree"))
    return rows.select("tree", F.expr(f"concat({', '.join(pieces)})").alias("key"), *columns)


def _shared_rows(classes: DataFrame, turn: int) -> DataFrame:
    """tree, key, node, root and short of the rows whose prefix holds rows of another component.

    Only numbers are shuffled to find them, not the keys and signatures of all rows.
    """
    place = F.xxhash64("tree", F.substring("key", 1, 4 * LEAST_DEPTH)).alias("place")
    slim = _ordered_keys(classes, turn, LEAST_DEPTH, "node", "root").select(place, "tree", "node", "root")
    by_place = slim.groupBy("place").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    shared = stage(by_place.where("low < high").select("place"), "shared")
    if shared.count() <= FEW_IDS:
        rows = _ordered_keys(classes, turn, DEPTH, "node", "root", "short")
        return rows.select("*", place).join(F.broadcast(shared), "place", "left_semi").drop("place")
    trees = slim.join(shared, "place", "left_semi").groupBy("node").agg(F.collect_set("tree").alias("trees"))
    return _ordered_keys(classes.join(stage(trees, "shared-trees"), "node"), turn, DEPTH, "node", "root", "short", trees="trees")


def candidates(classes: DataFrame, reach: int, turn: int = 0) -> DataFrame:
    """Distinct pairs (a < b) of neighbours in the orders, up to ``reach`` rows apart, in different
    components, with the number of agreeing half bytes; ``classes`` has node, root (its component),
    signature and short. Pairs across the bounds of key ranges are few and have the least number. Every ``turn`` deals the hashes to the orders anew."""
    ordered = _shared_rows(classes, turn).repartitionByRange("tree", "key", "node").sortWithinPartitions("tree", "key", "node")

    def pairs(trees, keys, nodes, roots, shorts):
        """All neighbour pairs of rows in order, and their agreement."""
        found, same = [np.zeros((0, 2), np.int64)], [np.zeros(0, np.int64)]
        for step in range(1, min(reach, len(trees) - 1) + 1):
            near = (trees[step:] == trees[:-step]) & (roots[step:] != roots[:-step])
            near &= (keys[step:, :LEAST_DEPTH] == keys[:-step, :LEAST_DEPTH]).all(axis=1)
            at = np.flatnonzero(near)
            x = shorts[at] ^ shorts[at + step]
            agree = ((x & 15) == 0).sum(axis=1) + ((x >> 4) == 0).sum(axis=1)
            at, agree = at[agree >= AGREE], agree[agree >= AGREE]
            found.append(np.stack([nodes[at], nodes[at + step]], axis=1))
            same.append(agree)
        return np.concatenate(found), np.concatenate(same)

    def matrix(column, kind, n):
        return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(n, -1)

    def unpack(batch):
        n = batch.num_rows
        tree, node, root = (batch.column(c).to_numpy() for c in ("tree", "node", "root"))
        return tree, matrix(batch.column("key"), ">u4", n), node, root, matrix(batch.column("short"), np.uint8, n)

    def run(batches):
        """Pairs inside a range; its first and last rows go out too (edge -1 and 1, b the root)."""
        from pyspark import TaskContext

        part, seen, tail = TaskContext.get().partitionId(), 0, None
        names = ["part", "edge", "at", "tree", "key", "a", "b", "same"]

        def out(edge, at, trees, keys, a, b, same):
            n = len(a)
            whole = ((np.full(n, part), np.full(n, edge), at, trees), pa.int32())
            return pa.RecordBatch.from_arrays(
                [
                    *(pa.array(np.asarray(x), whole[1]) for x in whole[0]),
                    pa.array([k.tobytes() for k in keys], pa.binary()) if edge else pa.nulls(n, pa.binary()),
                    pa.array(a, pa.int64()),
                    pa.array(b, pa.int64()),
                    pa.array(np.asarray(same), pa.int32()),
                ],
                names=names,
            )

        def border(edge, rows):
            n = len(rows[0])
            return out(edge, np.arange(n), rows[0], rows[1], rows[2], rows[3], np.zeros(n, int))

        for batch in batches:
            if not batch.num_rows:
                continue
            new = unpack(batch)
            if seen < reach:
                yield border(-1, tuple(x[: reach - seen] for x in new))
            held = new if tail is None else tuple(np.concatenate([t, x]) for t, x in zip(tail, new))
            seen += batch.num_rows
            got, same = pairs(*held)
            if len(got):
                yield out(0, np.zeros(len(got), int), np.zeros(len(got), int), (), got[:, 0], got[:, 1], same)
            tail = tuple(x[-reach:] for x in held)
        if tail is not None:
            yield border(1, tail)

    schema = "part int, edge int, at int, tree int, key binary, a long, b long, same int"
    found = stage(ordered.mapInArrow(run, schema), "neighbours")
    # the last rows before a bound and the first after it, 2 * reach rows per range
    edges = found.where("edge != 0")
    near = edges.select("tree", "key", F.col("a").alias("node"), F.col("b").alias("root"), "part", "edge", "at")
    joint = Window.partitionBy("tree", F.substring("key", 1, 4 * LEAST_DEPTH)).orderBy("key", "node", "part", "edge", "at")
    both = found.where("edge = 0").select("a", "b", "same")
    for i in range(1, reach + 1):
        across = near.select(F.col("node").alias("a"), F.lead("node", i).over(joint).alias("b"), "root", F.lead("root", i).over(joint).alias("other"))
        both = both.unionAll(across.where("root != other").select("a", "b", F.lit(AGREE).alias("same")))
    ends = (F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return both.where("a != b").select(*ends, "same").groupBy("a", "b").agg(F.max("same").alias("same"))


def shingle_sets(docs: DataFrame) -> DataFrame:
    """doc_id and its sorted distinct shingle hashes."""

    def run(batches):
        for batch in batches:
            for at, end, values, bounds in _sets(batch.column(1)):
                arrays = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, end - at), arrays], names=["node", "hashes"])

    return docs.mapInArrow(run, "node long, hashes array<long>")


def _sets_of(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """node and hashes of the texts whose id is a node of ``ids``. Only these texts are read again."""
    wanted = docs.select(F.col("doc_id").cast("long").alias("_id"), "text")
    few = ids.count() <= FEW_IDS
    wanted = wanted.join(F.broadcast(ids) if few else ids, F.col("_id") == F.col("node"), "left_semi")
    return stage(shingle_sets(wanted), "sets")


def confirmed(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs that reach the threshold on their full sets. Only texts of pairs are read again."""
    pairs = stage(pairs.select("a", "b"), "pairs")
    sets = _sets_of(stage(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "in-pairs"), docs)
    left = sets.select(F.col("node").alias("a"), F.col("hashes").alias("ha"))
    right = sets.select(F.col("node").alias("b"), F.col("hashes").alias("hb"))
    rows = pairs.join(right, "b").join(left, "a")
    both = rows.select("a", "b", F.size(F.array_intersect("ha", "hb")).alias("both"), (F.size("ha") + F.size("hb")).alias("sum"))
    found = stage(both.where(100 * F.col("both") >= SIMILAR * (F.col("sum") - F.col("both"))).select("a", "b"), "confirmed")
    forget(sets)
    return found


def _shared(values: np.ndarray, bounds: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets ``left`` with the sets ``right``."""
    _, code, seen = np.unique(values, return_inverse=True, return_counts=True)
    number = np.cumsum(seen > 1) - 1  # a shingle of one set is in no intersection
    row, kept = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)), seen[code] > 1
    row, code = row[kept], number[code[kept]]
    order = np.argsort(code, kind="stable")
    row, code = row[order], code[order]
    out = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, int(code[-1]) + 1 if len(code) else 0, COLUMNS):
        low, high = np.searchsorted(code, (at, at + COLUMNS))
        held = np.zeros((len(bounds) - 1, COLUMNS), np.float32)
        held[row[low:high], code[low:high] - at] = 1
        out += held[left] @ held[right].T
    return out


def crowded_links(classes: DataFrame, docs: DataFrame, turn: int) -> DataFrame:
    """The links between components inside the prefixes of a turn that have more rows than
    ``NEIGHBOURS`` reach: all pairs of rows of different components, on their full sets.

    The rows of a prefix are dealt by hash to blocks of bounded size, and each pair of blocks is a
    task's group. Rows of the component that has most rows there meet only the rows of others.
    ``classes`` has node, root, n_shingles and signature.
    """
    rows = _ordered_keys(classes, turn, LEAST_DEPTH, "node", "root", "n_shingles")
    by_root = rows.groupBy("tree", "key", "root").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("size"))
    groups = by_root.groupBy("tree", "key").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("roots"), F.sum("size").alias("size"),
        F.max(F.struct("n", "root", "size")).alias("most"),
    ).where(f"n > {NEIGHBOURS + 1} and roots > 1")

    def blocks(n, size):
        return F.greatest(F.ceil(n / BLOCK_ROWS), F.ceil(size / BLOCK_SHINGLES), F.lit(1)).cast("int")

    groups = stage(
        groups.select(
            "tree", "key", F.col("most.root").alias("main"), blocks(F.col("most.n"), F.col("most.size")).alias("mains"),
            blocks(F.col("n") - F.col("most.n"), F.col("size") - F.col("most.size")).alias("others"),
        ),
        "crowded",
    )
    members = stage(rows.join(groups, ["tree", "key"]).withColumn("is_main", F.col("root") == F.col("main")), "members")
    sets = _sets_of(stage(members.select("node").distinct(), "in-crowded"), docs)
    # a cell is a pair of blocks; blocks of the main component have negative numbers
    own = F.pmod(F.xxhash64("node"), F.when(F.col("is_main"), F.col("mains")).otherwise(F.col("others")).cast("long")).cast("int")
    count = F.sequence(F.lit(0), F.col("others") - 1)
    main_cells = F.transform(count, lambda j: F.struct((-1 - own).alias("x"), j.alias("y")))
    other_cells = F.concat(
        F.transform(count, lambda j: F.struct(F.least(own, j).alias("x"), F.greatest(own, j).alias("y"))),
        F.transform(F.sequence(F.lit(0), F.col("mains") - 1), lambda j: F.struct((-1 - j).alias("x"), own.alias("y"))),
    )
    cells = members.select(
        "tree", "key", "node", "root", own.alias("own"), "is_main",
        F.explode(F.when(F.col("is_main"), main_cells).otherwise(other_cells)).alias("cell"),
    )
    side = F.when(F.col("is_main"), F.col("cell.x")).otherwise(F.col("own"))
    dealt = cells.select("tree", "key", "cell.x", "cell.y", side.alias("side"), "node", "root").join(sets, "node")

    def link(table: pa.Table) -> pa.Table:
        x, y = table.column("x")[0].as_py(), table.column("y")[0].as_py()
        side, node, root = (table.column(c).to_numpy() for c in ("side", "node", "root"))
        hashes = table.column("hashes").combine_chunks()
        sizes = hashes.value_lengths().to_numpy().astype(np.int64)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        left, right = np.flatnonzero(side == x), np.flatnonzero(side == y)
        both = _shared(hashes.flatten().to_numpy(), bounds, left, right)
        near = 100 * both >= SIMILAR * (sizes[left][:, None] + sizes[right][None, :] - both)
        i, j = np.nonzero(near & (root[left][:, None] != root[right][None, :]))
        a, b = node[left[i]], node[right[j]]
        return pa.table({"a": pa.array(np.minimum(a, b), pa.int64()), "b": pa.array(np.maximum(a, b), pa.int64())})

    found = dealt.groupBy("tree", "key", "x", "y").applyInArrow(link, "a long, b long")
    links = stage(found.distinct(), "crowded-links")
    forget(sets)
    return links


def components(links: DataFrame) -> DataFrame:
    """node and root (the smallest node reachable) for all nodes of ``links`` (a, b).

    Large-star and small-star steps in turn; each hands a node's links to its smallest neighbour,
    so a hub costs no more than its links. Steps repeat until nothing changes.
    """
    def digest(rows):
        return rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()

    edges = stage(links.select("a", "b").where("a != b").distinct(), "links")
    before = digest(edges)
    while True:
        # a step makes at most twice the links; each task has its share of them
        tasks = max(FEW_TASKS, before["n"] // LINKS)
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).coalesce(tasks)
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct().coalesce(tasks)
        small = down.groupBy("a").agg(F.min("b").alias("m"))
        moved = down.join(small, "a").coalesce(tasks)
        new = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(small.select("a", F.col("m").alias("b")).coalesce(tasks))
        new = new.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        new = stage(new.coalesce(tasks), "links")
        after = digest(new)
        forget(edges)
        edges = new
        if tuple(before) == tuple(after):
            break
        before = after
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    every = roots.unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
    out = stage(every.coalesce(max(FEW_TASKS, after["n"] // LINKS)), "roots")
    forget(edges)
    return out


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept per row of ``docs``.

    NULL and empty texts have no shingles and a component of their own. Rows without doc_id can't
    be named: they link with nothing, component_id is NULL and they are kept. Rows that share a
    doc_id are one node. No rows give no rows.
    """
    sketch = stage(sketches(docs), "sketches")
    linked = sketch.where("n_shingles > 0 and doc_id is not null")
    members = linked.groupBy("set_high", "set_low").agg(F.min("doc_id").alias("node"))
    heads = stage(
        linked.withColumnRenamed("doc_id", "node")
        .join(members, ["set_high", "set_low", "node"])
        .dropDuplicates(["node", "set_high", "set_low"])
        .select("node", "n_shingles", "signature", "short"),
        "classes",
    )
    # signatures stay with the classes only; the rows keep their keys
    whole, sketch = sketch, stage(sketch.drop("signature", "short"), "set-keys")
    members = sketch.where("n_shingles > 0 and doc_id is not null").groupBy("set_high", "set_low").agg(F.min("doc_id").alias("node"))
    forget(whole)
    near = stage(candidates(heads.withColumn("root", F.col("node")), 1), "near")
    # the most alike smaller and larger neighbour of each class
    first = stage(
        near.groupBy("b").agg(F.max_by("a", "same").alias("a")).select("a", "b")
        .unionAll(near.groupBy("a").agg(F.max_by("b", "same").alias("b")).select("a", "b"))
        .distinct(),
        "first",
    )
    sure = confirmed(first, docs)
    links, checked, turn = sure, first, 0
    while True:
        turn += 1
        roots = components(links)
        known = heads.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        apart = candidates(known, NEIGHBOURS, turn).join(checked, ["a", "b"], "left_anti").select("a", "b")
        apart = stage(apart, "apart")
        more = confirmed(apart, docs)
        if more.isEmpty():
            break
        links, checked = links.unionAll(more), checked.unionAll(apart)
    # the last turn compared all rows of different components in the prefixes that its neighbours span
    crowded = crowded_links(known, docs, turn)
    final = roots if crowded.isEmpty() else components(links.unionAll(crowded))

    # a node's root; then all members of its class, and of classes that share its id
    named = members.join(final, "node", "left").withColumn("root", F.coalesce("root", "node"))
    labelled = sketch.join(named.select("set_high", "set_low", "root"), ["set_high", "set_low"], "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("root")).otherwise(F.col("doc_id"))
    return labelled.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the smallest id, once.

    Of rows that share an id one stays; rows without id stay.
    """
    decided = stage(near_duplicates(docs).select(F.col("doc_id").alias("_id"), "kept"), "decided")
    gone = decided.where(~F.col("kept")).select("_id").distinct()
    again = decided.where(F.col("kept") & F.col("_id").isNotNull()).groupBy("_id").agg(F.count(F.lit(1)).alias("n"))
    again = stage(again.where("n > 1").select("_id"), "repeated")
    out = stage(gone.unionAll(again).distinct(), "gone")
    rows = docs.select(F.struct("*").alias("_doc"), F.col("doc_id").cast("long").alias("_key"))

    def sized(ids):
        return F.broadcast(ids) if ids.count() <= FEW_IDS else ids

    left = rows.join(sized(out), F.col("_key") == F.col("_id"), "left_anti").select("_doc")
    twice = rows.join(sized(again), F.col("_key") == F.col("_id"), "left_semi")
    first = twice.groupBy("_key").agg(F.first("_doc").alias("_doc")).select("_doc")
    return left.unionAll(first).select(*[F.col(f"_doc.`{c}`").alias(c) for c in docs.columns])
