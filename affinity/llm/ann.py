"""Approximate nearest neighbours: NN-descent and greedy graph search.

Index. Equal vectors are one node, so a vector that a third of all rows share
costs one node. Each node starts with neighbours from a few orderings along
random directions. A round of NN-descent then brings the vectors of a node's
neighbours, forward and reverse, together and compares them with each other:
neighbours of neighbours, through joins. A pair is only sent on if it improves
the list of one of its ends. Rounds stop when few lists change.

Search. A query starts from the graph lists of its own node, if it is indexed,
and of the entry points nearest to it (a bounded sample of nodes). In each
round it expands its best unexpanded candidates through a join with the graph
and keeps the best ``beam``; it ends when nothing is left to expand. Queries
are rows of a DataFrame and many run at once.

Nearness is the cosine in double precision on the original vectors; ties go to
the smaller id. Recall is a property of the parameters (see the tests and
README). Members of a node beyond the first ``k + 1`` can never be among the k
nearest of anything, so only these are carried.

Defined results: vectors that are null, empty, zero or hold a null or
non-finite component, rows with a null id, and vectors whose length differs
from the most frequent one (the smaller of equals) take no part; rows that
repeat an id and vector are one row; an id with several vectors keeps the
smallest; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinity.llm.common import shared_table, ship_code

ENTRY_POINTS = 512  # nodes any search may start from


def usable(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec): the rows that take part, vectors as doubles, one row per id."""
    v = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    v = v.filter(F.col("id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0)
                 & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
                 & F.exists("vec", lambda x: x != 0))
    v = v.groupBy("id").agg(F.min("vec").alias("vec"))
    length = v.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").limit(1)
    return v.join(F.broadcast(length.select("n")), F.size("vec") == F.col("n"), "left_semi")


def _matrix(col: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(col), np.float32).reshape(len(col), -1) if len(col) else np.empty((0, 1), np.float32)


def _unit(vec):
    @F.pandas_udf("binary")
    def unit(v: pd.Series) -> pd.Series:
        m = np.stack(v.to_numpy()) if len(v) else np.empty((0, 1))
        m = m / np.abs(m).max(axis=1, keepdims=True)
        m = (m / np.linalg.norm(m, axis=1, keepdims=True)).astype(np.float32)
        return pd.Series([r.tobytes() for r in m], dtype=object)

    return unit(vec)


def _top(pairs: DataFrame, k: int) -> DataFrame:
    """The ``k`` best distinct neighbours of each node of (node, nbr, sim, new),
    and ``low``: the similarity that a further one must exceed."""
    best = pairs.groupBy("node", "nbr").agg(F.max("sim").alias("sim"), F.bool_and("new").alias("new"))
    order = Window.partitionBy("node").orderBy(F.desc("sim"), "nbr")
    kept = best.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k)
    return kept.withColumn("low", F.when(F.max("r").over(Window.partitionBy("node")) == k, F.min("sim").over(
        Window.partitionBy("node"))).otherwise(F.lit(-2.0).cast("float"))).drop("r")


def _best_of_batch(node: np.ndarray, nbr: np.ndarray, sim: np.ndarray, k: int) -> pd.DataFrame:
    """The ``k`` best distinct neighbours of each node among one batch's pairs."""
    order = np.lexsort((nbr, -sim, node))
    node, nbr, sim = node[order], nbr[order], sim[order]
    same = np.append(False, (node[1:] == node[:-1]) & (nbr[1:] == nbr[:-1]))  # equal pairs have equal similarity
    node, nbr, sim = node[~same], nbr[~same], sim[~same]
    first = np.flatnonzero(np.append(True, node[1:] != node[:-1])) if len(node) else np.empty(0, np.int64)
    rank = np.arange(len(node)) - np.repeat(first, np.diff(np.append(first, len(node))))
    keep = rank < k
    return pd.DataFrame({"node": node[keep], "nbr": nbr[keep], "sim": sim[keep]})


def _first_lists(nodes: DataFrame, k: int, directions: int, block: int, seed: int, dim: int) -> DataFrame:
    """Neighbours within blocks of nodes that are next to each other along random directions."""
    out = None
    for d in range(directions):
        line = np.random.default_rng(seed + d).standard_normal(dim).astype(np.float32)

        @F.pandas_udf("double")
        def along(u: pd.Series) -> pd.Series:
            return pd.Series(_matrix(u) @ line, dtype=np.float64)

        def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for at in range(0, len(pdf), block):
                    part = pdf.iloc[max(0, min(at, len(pdf) - block)):at + block]
                    ids, m = part["node"].to_numpy(), _matrix(part["unit"])
                    sims = m @ m.T
                    np.fill_diagonal(sims, -2)
                    take = min(k, len(ids) - 1)
                    if take > 0:
                        best = np.argpartition(-sims, take - 1, axis=1)[:, :take]
                        yield pd.DataFrame({"node": np.repeat(ids, take), "nbr": ids[best].ravel(),
                                            "sim": np.take_along_axis(sims, best, 1).ravel()})

        lined = nodes.withColumn("p", along("unit")).repartitionByRange("p").sortWithinPartitions("p")
        part = lined.select("node", "unit").mapInPandas(near, "node long, nbr long, sim float")
        out = part if out is None else out.union(part)
    return out.withColumn("new", F.lit(True))


def build_graph(nodes: DataFrame, dim: int, k: int = 32, rounds: int = 8, directions: int = 6, block: int = 512,
                settled: float = 0.03, seed: int = 11) -> DataFrame:
    """(node, nbrs): up to ``k`` neighbours per node of (node, unit), and up to
    ``k`` nodes that have it as theirs."""

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows are the members around one node: compare them with each other."""
        for pdf in batches:
            a, b, s = [], [], []
            for ids, new, units, lows in zip(pdf["ids"], pdf["new"], pdf["units"], pdf["lows"]):
                ids, at = np.unique(ids, return_index=True)
                m = np.frombuffer(b"".join([units[i] for i in at]), np.float32).reshape(len(ids), -1)
                low, new = np.asarray(lows, np.float32)[at], np.asarray(new, bool)[at]
                sims = m @ m.T
                fresh = new[:, None] | new[None, :]
                np.fill_diagonal(fresh, False)
                i, j = np.nonzero((sims > low[:, None]) & fresh)
                a.append(ids[i])
                b.append(ids[j])
                s.append(sims[i, j])
            if a:
                yield _best_of_batch(np.concatenate(a), np.concatenate(b), np.concatenate(s), k)

    graph = shared_table(_top(_first_lists(nodes, k, directions, block, seed, dim), k))
    for _ in range(rounds):
        # a member is a neighbour in either direction; a hub keeps its best 2 k
        back = Window.partitionBy("node").orderBy(F.desc("sim"), "member")
        reverse = graph.select(F.col("nbr").alias("node"), F.col("node").alias("member"), "sim", "new").withColumn(
            "r", F.row_number().over(back)).filter(F.col("r") <= 2 * k)
        both = graph.select("node", F.col("nbr").alias("member"), "new").union(reverse.select("node", "member", "new"))
        carried = nodes.join(graph.select("node", "low").distinct(), "node").select(F.col("node").alias("member"), "unit", "low")
        groups = both.join(carried, "member").groupBy("node").agg(
            F.collect_list(F.struct("member", "new", "unit", "low")).alias("m")).select(
            F.col("m.member").alias("ids"), F.col("m.new").alias("new"), F.col("m.unit").alias("units"), F.col("m.low").alias("lows"))
        found = groups.mapInPandas(compare, "node long, nbr long, sim float").withColumn("new", F.lit(True))
        graph = shared_table(_top(graph.select("node", "nbr", "sim", F.lit(False).alias("new")).union(found), k))
        total, changed = graph.agg(F.count("*"), F.count_if("new")).first()
        if changed <= settled * max(1, total):
            break
    # searches walk links both ways, so a node that is in no list can still be reached
    back = graph.select(F.col("nbr").alias("node"), F.col("node").alias("nbr"), "sim").withColumn(
        "r", F.row_number().over(Window.partitionBy("node").orderBy(F.desc("sim"), "nbr"))).filter(F.col("r") <= k)
    links = graph.select("node", "nbr").union(back.select("node", "nbr"))
    return shared_table(links.groupBy("node").agg(F.collect_set("nbr").alias("nbrs")))


STATE = "query long, unit binary, ids array<long>, sims array<float>, done array<boolean>, open array<long>"


def _advance(ids: np.ndarray, sims: np.ndarray, done: np.ndarray, beam: int, width: int) -> tuple:
    """Keep the best ``beam`` candidates; the best ``width`` that are not expanded yet come next."""
    order = np.lexsort((ids, -sims))[:beam]
    ids, sims, done = ids[order], sims[order], done[order].copy()
    now = np.flatnonzero(~done)[:width]
    done[now] = True
    return ids, sims, done, ids[now]


def search(queries: DataFrame, nodes: DataFrame, graph: DataFrame, keep: int, beam: int = 128, width: int = 32,
           rounds: int = 12) -> DataFrame:
    """(query, node): the ``keep`` best nodes found for each of ``queries``
    (query, unit, home); home is the query's own node or null. A query is one
    row with at most ``beam`` candidates."""
    entries = nodes.orderBy(F.xxhash64("node")).limit(ENTRY_POINTS).select("node", "unit").collect()
    entry_ids = np.array([r["node"] for r in entries], np.int64)
    entry_units = b"".join(bytes(r["unit"]) for r in entries)

    def start(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if pdf.empty:
                continue
            rows, e = [], np.frombuffer(entry_units, np.float32).reshape(len(entry_ids), -1)
            for query, unit, home in zip(pdf["query"], pdf["unit"], pdf["home"]):
                sims = e @ np.frombuffer(unit, np.float32)
                own = [] if pd.isna(home) else [int(home)]
                ids = np.concatenate([np.array(own, np.int64), entry_ids[~np.isin(entry_ids, own)]])
                near = np.concatenate([np.full(len(own), 2, np.float32), sims[~np.isin(entry_ids, own)]])
                rows.append((query, unit, *_advance(ids, near, np.zeros(len(ids), bool), beam, width)))
            yield pd.DataFrame(rows, columns=[f.split()[0] for f in STATE.split(", ")])

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for query, unit, ids, sims, done, met, units in zip(*(pdf[c] for c in ("query", "unit", "ids", "sims", "done", "met", "units"))):
                ids, sims, done = np.asarray(ids, np.int64), np.asarray(sims, np.float32), np.asarray(done, bool)
                fresh = np.flatnonzero(~np.isin(met, ids)) if met is not None else ()
                if len(fresh):
                    m = np.frombuffer(b"".join([units[i] for i in fresh]), np.float32).reshape(len(fresh), -1)
                    near = m @ np.frombuffer(unit, np.float32)
                    ids, sims = np.concatenate([ids, np.asarray(met, np.int64)[fresh]]), np.concatenate([sims, near])
                    done = np.concatenate([done, np.zeros(len(fresh), bool)])
                rows.append((query, unit, *_advance(ids, sims, done, beam, width)))
            yield pd.DataFrame(rows, columns=[f.split()[0] for f in STATE.split(", ")])

    state = shared_table(queries.mapInPandas(start, STATE))
    for _ in range(rounds):
        if state.filter("size(open) > 0").isEmpty():
            break
        reached = state.select("query", F.explode("open").alias("node")).join(graph, "node").select(
            "query", F.explode("nbrs").alias("node")).distinct()
        met = reached.join(nodes, "node").groupBy("query").agg(F.collect_list(F.struct("node", "unit")).alias("m")).select(
            "query", F.col("m.node").alias("met"), F.col("m.unit").alias("units"))
        state = shared_table(state.drop("open").join(met, "query", "left").mapInPandas(step, STATE))
    return state.select("query", F.explode(F.slice("ids", 1, keep)).alias("node"))


def nearest(rows: DataFrame, queries: DataFrame | None = None, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
            neighbours: int = 32, rounds: int = 8, beam: int = 128, width: int = 32, search_rounds: int = 12) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` (default: all
    of ``rows``; the same columns) the ``k`` nearest found among the other rows."""
    ship_code(rows.sparkSession)
    all_rows = shared_table(usable(rows, id_col, vec_col))
    # one node per distinct vector, named by its smallest id; its k + 1 smallest ids can be answers
    first = all_rows.groupBy("vec").agg(F.min("id").alias("node"))
    nodes = shared_table(first.select("node", "vec", _unit(F.col("vec")).alias("unit")))
    member = all_rows.join(first, "vec").select("node", "id")
    member = shared_table(member.withColumn("r", F.row_number().over(Window.partitionBy("node").orderBy("id"))).filter(
        F.col("r") <= k + 1).drop("r"))
    one = nodes.select(F.size("vec").alias("n")).limit(1).collect()
    wanted = all_rows if queries is None else all_rows.join(queries.select(F.col(id_col).cast("long").alias("id")).distinct(), "id", "left_semi")
    wanted = shared_table(wanted.join(first.withColumnRenamed("node", "home"), "vec").join(
        nodes.select(F.col("node").alias("home"), "unit"), "home").select(F.col("id").alias("query"), "home", "unit", "vec"))
    graph = build_graph(nodes.select("node", "unit"), one[0]["n"] if one else 1, neighbours, rounds)
    found = search(wanted.select("query", "unit", "home"), nodes.select("node", "unit"), graph, 2 * k + 1, beam, width, search_rounds)

    @F.pandas_udf("double")
    def score(a: pd.Series, b: pd.Series) -> pd.Series:
        if not len(a):
            return pd.Series([], dtype=np.float64)
        x, y = np.stack(a.to_numpy()), np.stack(b.to_numpy())
        x, y = (m / np.abs(m).max(axis=1, keepdims=True) for m in (x, y))
        dots = np.einsum("ij,ij->i", x, y)
        return pd.Series(dots / (np.sqrt(np.einsum("ij,ij->i", x, x)) * np.sqrt(np.einsum("ij,ij->i", y, y))))

    exact = found.join(nodes.select("node", F.col("vec").alias("v")), "node").join(wanted.select("query", "vec"), "query").select(
        "query", "node", score("vec", "v").alias("score"))
    listed = exact.join(member, "node").filter("id <> query").withColumn(
        "rank", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))).filter(F.col("rank") <= k)
    return listed.select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")
