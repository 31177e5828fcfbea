"""Splits that keep related records together.

Entities that belong together form components. A persisted table holds, for each entity, its component and the
component's split. A batch of edges is put between the components that the table already knows; only the roots that these
edges touch take part in the merge, by hooking onto smaller neighbours and jumping pointers until every root points at the
smallest id of its component. Then

* a component that contains entities of one split keeps that split,
* a component without any fills the splits' deficits,
* a component that would merge entities of several splits is quarantined: its rows leave all splits until someone decides,
  and `held` goes on telling which split each of its old entities was in.

New components are put into cells, by size (powers of two of their rows) and within a size by hash, CELLS cells a size. Cells,
largest first, go to the split whose misses of the shares (in all, and per stratum) they mend best. The same rule holds for
all components; where a size has no more components than cells, they mostly stand alone in theirs. What the driver sees is
bounded by 64 sizes x CELLS x STRATA.

Defined cases: a null entity is its own component (the rows are split by their key); edges with a null side say nothing;
repeated edges and rows count as such; no rows give empty tables; a share of zero gets nothing but what it already holds;
beyond STRATA strata some are balanced together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roomweave.functions.skew import HOT_ROWS, skew_left_join
from roomweave.session import written
from roomweave.sources import versions

SPLITS = (("train", 0.8), ("validation", 0.1), ("test", 0.1))
QUARANTINE = "quarantine"
#: Cells of components of like size, and strata that are told apart when cells are placed.
CELLS, STRATA = 64, 64
MAX_ROUNDS = 60


def forest(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a, b) that isn't the smallest of its component.

    Each round hooks every root onto the smallest root among its neighbours', jumps pointers among the hooked roots (root
    := root of root) and renames the edges, so rounds grow with the logarithm of a
    component's width. Edges inside one component leave at once. A root is hooked once, so the rounds' pointers together
    are a forest no deeper than there are rounds, whose pointers are jumped in the end. A hub with very many edges is met
    by map-side minima and by joins that keep hot keys apart; no group is ever collected.
    """
    ordered = lambda df: df.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    open_edges = written(ordered(edges.where(F.col("a").isNotNull() & F.col("b").isNotNull())))
    pointers = None
    for rounds in range(MAX_ROUNDS):
        n = open_edges.count()
        if n == 0:
            break
        # hook: every root that has a smaller neighbour points at the smallest
        hooked = _jumped(written(open_edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))), n)
        pointers = hooked if pointers is None else pointers.unionByName(hooked)
        renamed = open_edges
        for side in ("a", "b"):
            to = hooked.select(F.col("node").alias(side), F.col("root").alias("to"))
            renamed = skew_left_join(renamed, to, side, n_rows=n).withColumn(side, F.coalesce("to", side)).drop("to")
        open_edges = written(ordered(renamed))
    else:
        raise RuntimeError(f"no end after {MAX_ROUNDS} rounds")
    if pointers is None:
        return open_edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return pointers if rounds == 1 else _jumped(written(pointers))


def _jumped(pointers: DataFrame, n: int | None = None) -> DataFrame:
    """Kept pointers (node, root) jumped until none moves; at most `n` of them, where that is known."""
    n = pointers.count() if n is None else n
    while True:
        up = pointers.select(F.col("node").alias("root"), F.col("root").alias("above"))
        moved = skew_left_join(pointers, up, "root", n_rows=n).select("node", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved"))
        if n <= HOT_ROWS:  # few pointers: twice as far in the same job
            moved = moved.join(up, "root", "left").select("node", F.coalesce("above", "root").alias("root"), "moved")
        moved = written(moved)
        if not moved.agg(F.max("moved")).first()[0]:
            return pointers
        pointers = moved.select("node", "root")


def components(edges: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(node, root) for every node of edges (a, b), root being the smallest node of its component.

    `known` is an earlier (node, root) table: the edges are put between its roots, and only roots that merge change.
    """
    edges = edges.where(F.col("a").isNotNull() & F.col("b").isNotNull()).select("a", "b")
    nodes = edges.where(F.col("a") != F.col("b")).select(F.explode(F.array("a", "b")).alias("node")).distinct()
    if known is None:
        merged = forest(edges)
        return nodes.join(merged, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
    nodes = written(nodes)
    # what the batch says of known nodes is said of their roots; the large table is only cut down to the batch's nodes
    met = written(known.join(nodes, "node", "left_semi").select("node", "root"))
    edges = written(edges.distinct())
    n = edges.count()
    for side in ("a", "b"):
        edges = skew_left_join(edges, met.select(F.col("node").alias(side), "root"), side, n_rows=n).withColumn(side, F.coalesce("root", side)).drop("root")
    merged = written(forest(edges))
    fresh = nodes.join(met, "node", "left_anti").select("node", F.col("node").alias("root"))
    return skew_left_join(known.select("node", "root").unionByName(fresh), merged.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", n_rows=known.count() + fresh.count()).select("node", F.coalesce("to", "root").alias("root"))


def merge(edges: DataFrame, folder: str) -> DataFrame:
    """The kept component table in `folder` (node, root) after a batch of edges: its last version merged, written as the next."""
    return versions.save(components(edges, versions.latest(edges.sparkSession, folder)), folder)


def place(cells: dict[tuple, dict[int, int]], held: dict[str, dict[int, int]], shares: Sequence[tuple[str, float]]) -> dict[tuple, str]:
    """The split of each cell, given rows by stratum of the cells and of what the splits hold already."""
    held = {s: {-1: sum(held.get(s, {}).values()), **held.get(s, {})} for s, _ in shares}
    parts = {cell: {-1: sum(own.values()), **own} for cell, own in cells.items()}
    totals: dict[int, int] = {}
    for own in (*held.values(), *parts.values()):
        for k, n in own.items():
            totals[k] = totals.get(k, 0) + n
    out = {}
    for cell in sorted(parts, key=lambda c: (-parts[c][-1], c)):

        def miss(split: str, share: float, own: dict = parts[cell]) -> float:
            return sum(n * (held[split].get(k, 0) + n / 2 - share * totals[k]) / max(1.0, share * totals[k]) for k, n in own.items())

        out[cell] = min((x for x in shares if x[1] > 0), key=lambda x: (miss(*x), x[0]))[0]
        for k, n in parts[cell].items():
            held[out[cell]][k] = held[out[cell]].get(k, 0) + n
    return out


def _fill(sized: DataFrame, held: dict[str, dict[int, int]], shares: Sequence[tuple[str, float]], seed: int) -> DataFrame:
    """(root, split) for new components (root, stratum, n) given the rows that the splits hold already."""
    whole = sized.groupBy("root").agg(F.sum("n").alias("rows"))
    in_cell = whole.select("root", F.floor(F.log2(F.greatest("rows", F.lit(1)))).cast("int").alias("size"), F.pmod(F.xxhash64(F.lit(seed), "root"), F.lit(CELLS)).cast("int").alias("cell"))
    in_cell = written(in_cell)
    cells: dict[tuple, dict[int, int]] = {}
    for r in sized.join(in_cell, "root").groupBy("size", "cell", "stratum").agg(F.sum("n").alias("n")).collect():  # at most 64 x CELLS x STRATA
        cells.setdefault((r["size"], r.cell), {})[r.stratum] = r.n
    placed = [(*cell, split) for cell, split in place(cells, held, shares).items()]
    to = sized.sparkSession.createDataFrame(placed, "size int, cell int, split string")
    return in_cell.join(F.broadcast(to), ["size", "cell"]).select("root", "split")


def split_ledger(rows: DataFrame, edges: DataFrame, ledger: DataFrame | None = None, shares: Sequence[tuple[str, float]] = SPLITS, seed: int = 7) -> DataFrame:
    """The table of entities after a batch: (node, root, split, held).

    rows (entity, stratum) are all rows seen so far, edges (a, b) those of the batch, ledger the last table. `held` is the
    split that an entity is in or was in before its component was quarantined; null where it never was in any.
    """
    stratum = F.pmod(F.xxhash64(F.coalesce("stratum", F.lit(""))), F.lit(STRATA)).cast("int")
    per_node = written(rows.where(F.col("entity").isNotNull()).groupBy(F.col("entity").alias("node"), stratum.alias("stratum")).agg(F.count(F.lit(1)).alias("n")))
    tree = components(edges, ledger.select("node", "root") if ledger is not None else None)
    tree = per_node.select("node").distinct().join(tree, "node", "full_outer").select("node", F.coalesce("root", "node").alias("root"))
    tree = tree.join(ledger.select("node", "held"), "node", "left") if ledger is not None else tree.withColumn("held", F.lit(None).cast("string"))
    tree = written(tree)
    decided = written(tree.groupBy("root").agg(F.min("held").alias("least"), F.max("held").alias("most")))
    fixed = decided.where(F.col("least").isNotNull()).select("root", F.when(F.col("least") == F.col("most"), F.col("least")).otherwise(F.lit(QUARANTINE)).alias("split"))
    sized = written(per_node.join(tree, "node").groupBy("root", "stratum").agg(F.sum("n").alias("n")))
    taken: dict[str, dict[int, int]] = {}
    if ledger is not None:
        for r in sized.join(fixed, "root").groupBy("split", "stratum").agg(F.sum("n").alias("n")).collect():  # splits x STRATA
            taken.setdefault(r.split, {})[r.stratum] = r.n
    fresh = decided.where(F.col("least").isNull()).select("root")
    empty = fresh.join(sized.select("root").distinct(), "root", "left_anti").select("root", F.lit(0).alias("stratum"), F.lit(0).cast("bigint").alias("n"))
    assigned = fixed.unionByName(_fill(sized.join(fresh, "root", "left_semi").unionByName(empty), taken, shares, seed))
    out = skew_left_join(tree, assigned, "root", n_rows=tree.count())
    return out.select("node", "root", "split", F.coalesce("held", F.when(F.col("split") != QUARANTINE, F.col("split"))).alias("held"))


def update(rows: DataFrame, edges: DataFrame, folder: str, shares: Sequence[tuple[str, float]] = SPLITS, seed: int = 7) -> DataFrame:
    """The kept table in `folder` after a batch of edges: read from its last version, written as the next."""
    return versions.save(split_ledger(rows, edges, versions.latest(rows.sparkSession, folder), shares, seed), folder)


def split_of(rows: DataFrame, ledger: DataFrame, entity: str, key: Column, shares: Sequence[tuple[str, float]] = SPLITS, seed: int = 7) -> DataFrame:
    """Rows with `root` and `split` (in place of columns of these names); rows of no entity are split by their own key."""
    with_split = skew_left_join(rows.withColumn("_e", F.col(entity)), ledger.select(F.col("node").alias("_e"), "root", "split"), "_e").drop("_e")
    u = F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 30)) / F.lit(float(1 << 30))
    cut, alone = 0.0, F.lit(shares[0][0])
    for s, share in shares:
        alone = F.when(u >= F.lit(cut), F.lit(s)).otherwise(alone) if share > 0 else alone
        cut += share
    return with_split.withColumn("split", F.coalesce("split", alone))


def split_report(split_rows: DataFrame) -> DataFrame:
    """(stratum, split, rows, share): how the split rows are spread, `*` being all strata."""
    counted = split_rows.groupBy(F.coalesce("stratum", F.lit("")).alias("stratum"), "split").agg(F.count(F.lit(1)).alias("rows"))
    both = counted.unionByName(counted.groupBy("split").agg(F.sum("rows").alias("rows")).withColumn("stratum", F.lit("*")))
    return both.withColumn("share", F.col("rows") / F.sum("rows").over(Window.partitionBy("stratum")))
