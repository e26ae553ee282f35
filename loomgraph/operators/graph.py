"""Degree, PageRank and communities of a link graph: vertices(id), edges(src, dst), edges kept with their multiplicity.

Iterations keep the edges in a bucketed table, by the end that meets the values of a round: a round reads them as they lie, and only the values of
vertices and the pre-aggregated sums move. An end with more than ``CUT`` neighbours is cut into parts that lie in
buckets of their own; the few vertices with parts send their value to each.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from loomgraph.config import LABEL_ROUNDS, PAGERANK_DAMPING, PAGERANK_EPSILON, PAGERANK_ITERATIONS

#: Neighbours of one vertex in one bucket at most, about.
CUT = 1_000_000


def _folder(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None)
    base = named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/.shared"
    if not named and not spark.sparkContext.master.startswith("local") and base.startswith(("file:", "/")):
        raise ValueError("on a cluster, spark.checkpoint.dir must name a folder that all machines share")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/loomgraph-{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)  # what is still there when the driver ends
    return f"{path.toString()}/graph-{uuid.uuid4().hex}"


class Rounds:
    """Tables of an iteration, written to the shared folder; the one before last is deleted, so disk use stays at two rounds."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folder, self.n, self.tables, self.named = spark, _folder(spark), 0, [], []

    def _delete(self, path: str) -> None:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)

    def put(self, df: DataFrame, name: str = "") -> DataFrame:
        path = f"{self.folder}/{name or self.n}"
        df.write.parquet(path)
        if name:
            self.named.append(name)
        else:
            self.n += 1
            if self.n > 2:
                self._delete(f"{self.folder}/{self.n - 3}")
        return self.spark.read.schema(df.schema).parquet(path)

    def bucketed(self, df: DataFrame, name: str, *by: str) -> DataFrame:
        """df as a table whose buckets are the shuffle partitions of a join by these columns."""
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.tables.append(f"loomgraph_{name}_{uuid.uuid4().hex}")
        self.named.append(name)
        df.repartition(n, *by).write.bucketBy(n, *by).sortBy(*by).option("path", f"{self.folder}/{name}").saveAsTable(self.tables[-1])
        return self.spark.table(self.tables[-1])

    def settled(self) -> None:
        """No round follows: what rounds read goes; the last values stay for their readers, until the application ends."""
        for table in self.tables:
            self.spark.sql(f"drop table if exists {table}")
        for name in self.named:
            self._delete(f"{self.folder}/{name}")

    def delete(self) -> None:
        self.settled()
        self._delete(self.folder)


def closed(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges whose both ends are vertices."""
    out = edges.join(vertices.select(F.col("id").alias("src")), "src", "left_semi")
    return out.join(vertices.select(F.col("id").alias("dst")), "dst", "left_semi").select("src", "dst")


def _count(edges: DataFrame, end: str, name: str) -> DataFrame:
    return edges.groupBy(F.col(end).alias("id")).agg(F.count(F.lit(1)).alias(name))


def out_degree(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    return vertices.select("id").join(_count(edges, "src", "d"), "id", "left").select("id", F.coalesce("d", F.lit(0)).alias("out_degree"))


def in_degree(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    return vertices.select("id").join(_count(edges, "dst", "d"), "id", "left").select("id", F.coalesce("d", F.lit(0)).alias("in_degree"))


def degree(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """In plus out; parallel edges count each, a loop counts twice."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("d"))
    return vertices.select("id").join(ends, "id", "left").select("id", F.coalesce("d", F.lit(0)).alias("degree"))


@dataclass
class Ranks:
    ranks: DataFrame
    iterations: int


def weighted(edges: DataFrame) -> DataFrame:
    """src, dst, w: parallel edges as one, with their share of the source's out-degree."""
    one = edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))
    total = one.groupBy("src").agg(F.sum("n").alias("out"))
    return one.join(total, "src").select("src", "dst", (F.col("n") / F.col("out")).alias("w"))


def _parts(rows: DataFrame, end: str) -> DataFrame:
    """id, parts of the ends with more than CUT rows; there are at most rows / CUT."""
    return rows.groupBy(F.col(end).alias("id")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CUT).select("id", F.ceil(F.col("n") / CUT).cast("long").alias("parts"))


def _cut(rows: DataFrame, end: str, other: str, parts: DataFrame) -> DataFrame:
    """rows with the column part: 0, or by hash of the other end where ``end`` is cut."""
    met = rows.join(parts.withColumnRenamed("id", "cut"), F.col(end) == F.col("cut"), "left")
    return met.withColumn("part", F.coalesce(F.expr(f"pmod(xxhash64({other}), parts)"), F.lit(0).cast("long"))).drop("cut", "parts")


def _sent(values: DataFrame, parts: DataFrame, end: str) -> DataFrame:
    """values(id, ...) once for each part, as (end, part, ...)."""
    met = values.withColumnRenamed("id", end).join(parts.withColumnRenamed("id", "cut"), F.col(end) == F.col("cut"), "left")
    return met.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1).cast("long")) - 1))).drop("cut", "parts")


def _spread(w: DataFrame, ranks: DataFrame, parts: DataFrame | None) -> DataFrame:
    """id, s: what each vertex is sent in one round."""
    if parts is None:
        met = w.join(ranks.select(F.col("id").alias("src"), "rank"), "src")
    else:
        met = w.join(_sent(ranks.select("id", "rank"), parts, "src"), ["src", "part"])
    return met.groupBy(F.col("dst").alias("id")).agg(F.sum(F.col("rank") * F.col("w")).alias("s"))


def pagerank(vertices: DataFrame, edges: DataFrame, *, damping: float = PAGERANK_DAMPING, max_iterations: int = PAGERANK_ITERATIONS, epsilon: float | None = PAGERANK_EPSILON) -> Ranks:
    """id, rank. Ranks start at 1/n; what vertices without out-edges hold is lost; stops once the summed change is below epsilon.

    Edges are weighted once and lie bucketed by source; a round is one join, which moves ranks alone, and one pre-aggregated
    sum, so a hub's in-edges meet as partial sums.
    """
    spark, rounds = vertices.sparkSession, Rounds(vertices.sparkSession)
    v = rounds.put(vertices.select("id").distinct(), "vertices")
    n = v.count()
    if not n:
        return Ranks(v.select("id", F.lit(0.0).alias("rank")), 0)
    w = rounds.put(weighted(edges), "weighted")
    parts = rounds.put(_parts(w, "src"), "parts")
    cut = not parts.isEmpty()
    w = rounds.bucketed(_cut(w, "src", "dst", parts), "edges", "src", "part") if cut else rounds.bucketed(w, "edges", "src")
    ranks, done = v.select("id", F.lit(1.0 / n).alias("rank")), 0
    for done in range(1, max_iterations + 1):  # noqa: B007
        sums = _spread(w, ranks, parts if cut else None)
        new = ranks.withColumnRenamed("rank", "old").join(sums, "id", "left").select("id", ((1 - damping) / n + damping * F.coalesce("s", F.lit(0.0))).alias("rank"), "old")
        seen = Observation(f"ranks-{uuid.uuid4().hex}")
        new = rounds.put(new.observe(seen, F.sum(F.abs(F.col("rank") - F.col("old"))).alias("change")) if epsilon is not None else new)
        change = seen.get["change"] if epsilon is not None else None
        ranks = new.select("id", "rank")
        if change is not None and change < epsilon:
            break
    rounds.settled()
    return Ranks(ranks, done)


def _votes(near: DataFrame, labels: DataFrame, parts: DataFrame | None) -> DataFrame:
    """id, community, n: labels of each vertex's neighbours in one round."""
    if parts is None:
        met = near.join(labels.select(F.col("id").alias("near"), "community"), "near")
    else:
        met = near.join(_sent(labels.select("id", "community"), parts, "near"), ["near", "part"])
    return met.groupBy("id", "community").agg(F.sum("n").alias("n"))


def communities(vertices: DataFrame, edges: DataFrame, *, max_rounds: int = LABEL_ROUNDS, mode: str = "rounds") -> DataFrame:
    """id, community by label propagation over both directions with multiplicity; labels are vertex ids.

    ``rounds``: all vertices at once; the most frequent label among the neighbours wins, the own one on a tie, then the least.
    Neighbours lie bucketed by the one whose label is sent, so a round moves labels and counted votes alone. Labels depend on those of the round before alone, so once
    they are what they were two rounds ago, what the last round leaves is known.
    ``in place``: one vertex after another, in order of its colour (``coloured``), then id, seeing labels set before it, with the same ties: so it settles
    where all at once may swing. Vertices of one colour have no edges between them and are updated together.
    """
    if mode == "in place":
        return _in_place(vertices, edges, max_rounds)
    if mode != "rounds":
        raise ValueError(f"no mode {mode!r}")
    rounds = Rounds(vertices.sparkSession)
    both = edges.select(F.explode(F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))).alias("e")).select("e.*")  # one pass over the edges
    counted = rounds.put(both.groupBy(F.col("src").alias("id"), F.col("dst").alias("near")).agg(F.count(F.lit(1)).alias("n")), "counted")
    parts = rounds.put(_parts(counted, "near"), "parts")
    cut = not parts.isEmpty()
    near = rounds.bucketed(_cut(counted, "near", "id", parts), "near", "near", "part") if cut else rounds.bucketed(counted, "near", "near")
    labels = rounds.put(vertices.select("id", F.col("id").alias("community"), F.lit(None).cast("long").alias("before")).distinct())
    for turn in range(1, max_rounds + 1):
        votes = _votes(near, labels, parts if cut else None)
        own = labels.select("id", F.col("community").alias("own"))
        best = votes.join(own, "id").groupBy("id").agg(F.max(F.struct("n", (F.col("community") == F.col("own")).alias("same"), (-F.col("community")).alias("least"))).alias("best"))
        seen = Observation(f"labels-{uuid.uuid4().hex}")
        new = labels.join(best, "id", "left").select("id", F.coalesce(-F.col("best.least"), "community").alias("community"), F.col("community").alias("before"), F.col("before").alias("last"))
        differ = lambda c: F.count_if(~F.col("community").eqNullSafe(F.col(c)))
        labels = rounds.put(new.observe(seen, differ("before").alias("moved"), differ("last").alias("swung")).drop("last"))
        told = seen.get
        if not told.get("moved"):
            break
        if not told.get("swung"):  # as two rounds ago: from here on labels only swing between these and those before
            if (max_rounds - turn) % 2:
                labels = labels.select("id", F.col("before").alias("community"))
            break
    rounds.settled()
    return labels.select("id", "community")


def _priority(col: str) -> F.Column:
    """A random number for each vertex, the same in every run, made unique by the id."""
    return F.struct(F.xxhash64(F.col(col)).alias("h"), F.col(col).alias("id"))


def coloured(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """id, colour (from 0): neighbours have different colours. A vertex takes the least colour that none of its neighbours of higher priority has, once all of these have theirs.

    Every round colours all vertices whose higher neighbours are done; its edges are those of the vertices that still wait, so
    they get fewer each time, and the number of rounds is that of the longest chain of rising priorities (short, as they are random).
    """
    rounds = Rounds(vertices.sparkSession)
    v = vertices.select("id").distinct()
    up = edges.where("src <> dst").select(F.when(_priority("src") < _priority("dst"), F.struct(F.col("src").alias("u"), F.col("dst").alias("v"))).otherwise(F.struct(F.col("dst").alias("u"), F.col("src").alias("v"))).alias("e"))
    waiting = rounds.put(up.select("e.*").distinct().withColumn("colour", F.lit(None).cast("int")))
    done = [rounds.put(v.join(waiting.select(F.col("u").alias("id")), "id", "left_anti").select("id", F.lit(0).alias("colour")), "colours-0")]
    while not waiting.isEmpty():
        last = done[-1].select(F.col("id").alias("v"), F.col("colour").alias("new"))
        met = waiting.join(last, "v", "left").select("u", "v", F.coalesce("colour", "new").alias("colour"))
        state = met.groupBy("u").agg(F.count_if(F.col("colour").isNull()).alias("open"), F.collect_set("colour").alias("taken"))
        free = F.array_min(F.array_except(F.sequence(F.lit(0), F.size("taken")), "taken"))  # as many as there are colours
        done.append(rounds.put(state.where("open = 0").select(F.col("u").alias("id"), free.alias("colour")), f"colours-{len(done)}"))
        waiting = rounds.put(met.join(done[-1].select(F.col("id").alias("u")), "u", "left_anti"))
    spark = vertices.sparkSession
    kept = Rounds(spark)
    out = kept.put(spark.read.schema(done[0].schema).parquet(*(f"{rounds.folder}/colours-{n}" for n in range(len(done)))))
    rounds.delete()
    return out


def _in_place(vertices: DataFrame, edges: DataFrame, max_rounds: int) -> DataFrame:
    """One colour after another: a class has no edges inside, so all of its vertices are updated at once, and the next one sees what they became."""
    spark, rounds = vertices.sparkSession, Rounds(vertices.sparkSession)
    kept = rounds.put(closed(vertices, edges), "edges")
    colours = coloured(vertices, kept)
    both = kept.where("src <> dst").select(F.explode(F.array(F.struct(F.col("src").alias("id"), F.col("dst").alias("near")), F.struct(F.col("dst").alias("id"), F.col("src").alias("near")))).alias("e")).select("e.*")
    near = both.groupBy("id", "near").agg(F.count(F.lit(1)).alias("n")).join(colours, "id")
    near.repartitionByRange("colour", "id", "near").write.partitionBy("colour").parquet(f"{rounds.folder}/near")
    near = spark.read.schema("id long, near long, n long, colour int").parquet(f"{rounds.folder}/near")
    loops = kept.where("src = dst").groupBy(F.col("src").alias("id")).agg((2 * F.count(F.lit(1))).alias("loops"))
    colours.join(loops, "id", "left").select("id", F.col("id").alias("community"), F.coalesce("loops", F.lit(0)).alias("loops"), F.lit(False).alias("moved"), "colour").repartitionByRange("colour", "id").write.partitionBy("colour").parquet(f"{rounds.folder}/labels")
    row = "id long, community long, loops long, moved boolean"
    classes = [r.colour for r in colours.select("colour").distinct().orderBy("colour").collect()]  # colours are few
    at = {c: f"{rounds.folder}/labels/colour={c}" for c in classes}
    quiet = dict.fromkeys(classes, False)  # whether nothing moved since this class was last looked at
    step, wrote, looked = 0, dict.fromkeys(classes, 0), dict.fromkeys(classes, 0)  # when a class was written, and looked at
    for turn in range(max_rounds):
        for c in classes:
            if quiet[c]:
                continue
            own = spark.read.schema(row).parquet(at[c])
            labels = spark.read.schema(row).parquet(*(at[x] for x in classes if x != c)) if len(classes) > 1 else own.limit(0)
            mine, still = near.where(F.col("colour") == c), None
            if turn:  # a vertex without a neighbour that moved since would choose what it has
                moved = spark.read.schema(row).parquet(*(at[x] for x in classes if wrote[x] > looked[c])).where("moved").select(F.col("id").alias("near"))
                active = rounds.put(mine.join(moved, "near", "left_semi").select("id").distinct(), f"active-{turn}-{c}")
                still = own.join(active, "id", "left_anti").withColumn("moved", F.lit(False))
                mine, own = mine.join(active, "id", "left_semi"), own.join(active, "id", "left_semi")
            else:
                labels = labels.hint("merge")  # every edge is met once here: nothing of that goes through the driver
            votes = mine.join(labels.select(F.col("id").alias("near"), "community"), "near").select("id", "community", "n", F.lit(0).alias("own"), F.lit(0).cast("long").alias("loops"))
            votes = votes.unionByName(own.select("id", "community", F.col("loops").alias("n"), F.lit(1).alias("own"), "loops"))
            counted = votes.groupBy("id", "community").agg(F.sum("n").alias("n"), F.max("own").alias("own"), F.max("loops").alias("loops"))
            best = counted.groupBy("id").agg(F.max(F.struct("n", "own", (-F.col("community")).alias("least"))).alias("best"), F.max("loops").alias("loops"))
            path = f"{rounds.folder}/moved-{turn}-{c}"
            new = best.select("id", (-F.col("best.least")).alias("community"), "loops", (F.col("best.own") == 0).alias("moved"))
            (new if still is None else new.unionByName(still.select("id", "community", "loops", "moved"))).write.parquet(path)
            if turn:
                rounds._delete(f"{rounds.folder}/{rounds.named.pop()}")
            step += 1
            wrote[c] = looked[c] = step
            rounds._delete(at[c])
            at[c] = path
            if not spark.read.schema(row).parquet(path).where("moved").isEmpty():
                quiet = dict.fromkeys(classes, False)
            quiet[c] = True
        if all(quiet.values()):
            break
    rounds.named += ["edges", "near"]
    rounds.settled()
    return spark.read.schema(row).parquet(*at.values()).select("id", "community")


def community_sizes(labels: DataFrame) -> DataFrame:
    return labels.groupBy("community").agg(F.count(F.lit(1)).alias("size"))


@dataclass
class Metrics:
    table: DataFrame
    edges: DataFrame
    iterations: int


@contextmanager
def metrics(vertices: DataFrame, edges: DataFrame, *, damping: float = PAGERANK_DAMPING, iterations: int = PAGERANK_ITERATIONS, epsilon: float = PAGERANK_EPSILON, label_rounds: int = LABEL_ROUNDS, label_mode: str = "rounds") -> Iterator[Metrics]:
    """table(id, pagerank, community, degree) of every vertex, the edges between vertices, and the PageRank iterations run; its own tables go at the end."""
    rounds = Rounds(vertices.sparkSession)
    kept = rounds.put(closed(vertices, edges), "closed")
    ranks = pagerank(vertices, kept, damping=damping, max_iterations=iterations, epsilon=epsilon)
    labels = communities(vertices, kept, max_rounds=label_rounds, mode=label_mode)
    out = vertices.select("id").join(ranks.ranks.withColumnRenamed("rank", "pagerank"), "id", "left").join(labels, "id", "left").join(degree(vertices, kept), "id", "left")
    try:
        yield Metrics(out, kept, ranks.iterations)
    finally:
        rounds.delete()


def neighbours(links: DataFrame, articles: DataFrame, page_id: int) -> DataFrame:
    """Articles one link away, one row for each link."""
    return links.where(F.col("src") == page_id).join(articles, F.col("dst") == F.col("id")).select("id", "title")
