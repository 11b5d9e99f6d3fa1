"""A Merkle manifest of a table: one tree per source, one tree over the sources, and a proof for each row.

``H`` is the lower-case hex SHA-256 of its concatenated inputs, digests going in as hex text. A row's leaf is ``H`` of
its columns, each ``-`` if null, else UTF-8 byte count, ``:`` and value. The leaves of a tree are in order; while several
nodes remain, every ``FANOUT`` consecutive ones become their ``H``, the last run with fewer, even with one.

Leaves are sorted by range and numbered from what the earlier ranges hold, and cut into partitions: aligned blocks of
``FANOUT ** 3`` places of one tree. A block hashes its own three levels. Then blocks exchange as in a butterfly: in
round r, blocks that agree in all digits of their number (base ``FANOUT``) below and above digit r form a group of at
most ``FANOUT``; each sends the others the root of the subtree that it knows by now. Every member hashes their common
ancestor again for itself and keeps the others' roots as its next proof step, so after the last round each block has
its tree's root and the upper part of its rows' proofs, without a pass downwards. The last subtree of a tree may lack the
blocks that the full ones have; its blocks send to all lanes that would otherwise get nothing. What travels in a
round is one row per block and member. A tree with a third of all rows is many blocks like any other.

The subroots, in order of source (null first, UTF-8 bytewise), are the leaves of a second such forest of one tree.

Leaves order by ``order`` (null first), ties by leaf, so equal rows are interchangeable. Rows of the null source form a
tree like others. Empty texts are values of 0 bytes, and a text of any length is hashed whole. An empty table gives no
rows. Extra columns are ignored unless named.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicata.llm import common as C

FANOUT = 16
#: Levels that a block hashes by itself: it holds ``FANOUT ** LOCAL`` leaves at most.
LOCAL = 3
#: Rows with their proofs that leave a task together.
ROWS_OUT = 256
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf(values: Sequence[Column]) -> Column:
    """``H`` of the values' framed text."""
    framed = []
    for value in values:
        text = value.cast("string")
        size = F.octet_length(text).cast("string")
        framed.append(F.when(text.isNull(), F.lit("-")).otherwise(F.concat(size, F.lit(":"), text)))
    return F.sha2(F.concat(*framed).cast("binary"), 256)


def _h(parts: Sequence[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def height(n: int, fanout: int = FANOUT) -> int:
    """Levels above the leaves of a tree of ``n`` leaves."""
    levels = 0
    while n > 1:
        n = -(-n // fanout)
        levels += 1
    return levels


def raised(nodes: list[str], levels: int, fanout: int) -> list[list[str]]:
    """The nodes of each level, from the given ones up."""
    found = [nodes]
    for _ in range(levels):
        below = found[-1]
        found.append([_h(below[i : i + fanout]) for i in range(0, len(below), fanout)])
    return found


STEPS = "array<struct<before:string,after:string>>"


def numbered(leaves: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """``leaves`` with ``place``, from 0 in each tree, and the number of leaves of its tree as ``size``.

    The rows are sorted into ranges, so a tree of any size is spread; a row's place is that in its range after
    what earlier ranges hold. The second step has one row per range and tree.
    """
    sorted_ = leaves.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
    # the number has the range above 33 bits and the row in the range below
    ranges = C.cut(sorted_.withColumn("_at", F.monotonically_increasing_id()))
    ranges = ranges.withColumn("_range", F.shiftright("_at", 33))
    held = ranges.groupBy(tree, "_range").agg(F.count(F.lit(1)).alias("_held"), F.min("_at").alias("_first"))
    before = C.running_before(held, [tree], "_range", "_held", "_before").join(held, [tree, "_range"])
    sizes = held.groupBy(tree).agg(F.sum("_held").cast("long").alias("size"))
    found = ranges.join(before.drop("_held"), [tree, "_range"]).join(sizes, tree)
    place = F.col("_at") - F.col("_first") + F.col("_before")
    return found.withColumn("place", place).drop("_at", "_range", "_first", "_before")


def _own_levels(leaves: pa.ListScalar, size: int, fanout: int, local: int) -> list[list[str]]:
    """The nodes of a block, level by level; a tree of ``size`` leaves may end below the block's last level."""
    return raised(leaves.values.field("leaf").to_pylist(), min(local, height(size, fanout)), fanout)


def _tops(fanout: int, local: int):
    def tops(leaves: pa.Array, sizes: pa.Array) -> pa.Array:
        found = [_own_levels(own, n, fanout, local)[-1][0] for own, n in zip(leaves, sizes.to_pylist())]
        return pa.array(found, pa.string())

    return tops


def _proofs(fanout: int, local: int, row: T.StructType):
    def proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = dict(zip(batch.schema.names, batch.columns))
            steps_type = column["steps"].type
            for i in range(batch.num_rows):
                leaves, upper = column["leaves"][i], column["steps"][i].as_py()
                levels = _own_levels(leaves, column["size"][i].as_py(), fanout, local)
                for begin in range(0, len(levels[0]), ROWS_OUT):
                    some = leaves.values.slice(begin, ROWS_OUT)
                    steps = []
                    for at in range(begin, begin + len(some)):
                        own = []
                        for nodes in levels[:-1]:
                            first = at // fanout * fanout
                            sides = nodes[first:at], nodes[at + 1 : first + fanout]
                            own.append({"before": "".join(sides[0]), "after": "".join(sides[1])})
                            at //= fanout
                        steps.append(own + upper)
                    cells = [pa.array([column["root"][i].as_py()] * len(some), pa.string())]
                    cells += [pa.array([column["subroot"][i].as_py()] * len(some), pa.string())]
                    cells += [pa.array(steps, steps_type), *[some.field(f.name) for f in row]]
                    yield pa.RecordBatch.from_arrays(cells, names=["root", "subroot", "steps", *row.names])

    return proofs


class Forest:
    """Trees over ordered leaves: their blocks, and what each block knows after the exchange."""

    def __init__(self, leaves: DataFrame, order: Sequence[str], fanout: int = FANOUT, local: int = LOCAL):
        """``leaves`` has ``tree`` (no nulls), ``leaf``, the ``order`` columns and what else its rows carry."""
        self.fanout, self.local = fanout, local
        placed = numbered(leaves, "tree", [*order, "leaf"])
        row = F.struct("place", *[c for c in leaves.columns if c != "tree"])
        block = F.expr(f"place div {fanout**local}").alias("block")
        # at most fanout ** local rows a block
        grouped = placed.groupBy("tree", "size", block).agg(F.sort_array(F.collect_list(row)).alias("leaves"))
        self.blocks = C.cut(grouped)
        self.known = self._exchanged()

    def _exchanged(self) -> DataFrame:
        """Per block the ``root`` of its tree and ``steps``, the siblings of each round before and after its own side."""
        top = F.arrow_udf(_tops(self.fanout, self.local), "string")
        state = self.blocks.select("tree", "size", "block", top("leaves", "size").alias("node"))
        state = C.cut(state.withColumn("steps", F.array().cast(STEPS)))
        largest = state.agg(F.max("size")).first()[0] or 0
        for r in range(height(largest, self.fanout) - self.local):
            state = self._round(state, r)
        return state.select("tree", "block", F.col("node").alias("root"), "steps")

    def _round(self, state: DataFrame, r: int) -> DataFrame:
        """The members of each group swap the roots of their subtrees and each hash the ancestor."""
        held, width = self.fanout**self.local, self.fanout**r  # leaves of a block, blocks of a full subtree
        blocks = f"((size + {held - 1}) div {held})"
        open_ = F.expr(f"{blocks} > {width}")  # other trees have come to one node
        asked = state.where(open_).withColumns(
            {
                "lane": F.expr(f"block % {width}"),
                "digit": F.expr(f"block div {width} % {self.fanout}"),
                "grouped": F.expr(f"block div {width * self.fanout}"),
                # blocks of its subtree; a last one with fewer also sends to the lanes it has no block for
                "members": F.expr(f"least({width}, {blocks} - block div {width} * {width})"),
            }
        )
        lanes = F.explode(F.expr(f"sequence(lane, {width - 1}, members)")).alias("lane")
        sent = asked.select("tree", "grouped", lanes, "digit", "node")
        roots = F.sort_array(F.collect_list(F.struct("digit", "node"))).alias("roots")  # at most the fanout
        heard = sent.groupBy("tree", "grouped", "lane").agg(roots)
        met = asked.join(heard, ["tree", "grouped", "lane"])

        def text(keep=None) -> Column:
            return F.concat_ws("", F.transform(F.filter("roots", keep) if keep else F.col("roots"), lambda x: x["node"]))

        step = F.struct(
            text(lambda x: x["digit"] < F.col("digit")).alias("before"),
            text(lambda x: x["digit"] > F.col("digit")).alias("after"),
        )
        ancestor = F.sha2(text().cast("binary"), 256).alias("node")
        risen = met.select("tree", "size", "block", ancestor, F.concat("steps", F.array(step)).alias("steps"))
        return C.cut(risen.unionByName(state.where(~open_)))

    def roots(self) -> DataFrame:
        """``tree`` and its ``root``."""
        return self.known.where("block = 0").select("tree", "root")

    def rows(self, above: DataFrame | None = None) -> DataFrame:
        """What each leaf carries, its ``subroot``, ``root`` and ``steps``, its siblings from the leaf to the root.

        ``above`` has the ``root`` and the further ``steps`` of each ``tree`` where the trees' roots are leaves themselves.
        """
        known = self.blocks.join(self.known.withColumnRenamed("root", "subroot"), ["tree", "block"])
        if above is None:
            known = known.withColumn("root", F.col("subroot"))
        else:
            higher = above.select("tree", "root", F.col("steps").alias("higher"))
            known = known.join(higher, "tree").withColumn("steps", F.concat("steps", "higher"))
        row = self.blocks.schema["leaves"].dataType.elementType
        fields = [T.StructField("root", T.StringType()), T.StructField("subroot", T.StringType())]
        shape = T.StructType([*fields, T.StructField("steps", known.schema["steps"].dataType), *row])
        wanted = known.select("size", "leaves", "root", "subroot", "steps")
        return wanted.mapInArrow(_proofs(self.fanout, self.local, row), shape)


def manifest(
    df: DataFrame,
    columns: Sequence[str] = COLUMNS,
    source: str = "source",
    order: str = "doc_id",
    carry: Sequence[str] = (),
    fanout: int = FANOUT,
    local: int = LOCAL,
) -> DataFrame:
    """``order`` and ``source``, ``leaf``, ``subroot``, ``root`` and ``steps`` of each row, and ``row``, the struct of what it carries."""
    leaves = df.select(
        C.never_null(f"`{source}`").alias("tree"),
        F.col(f"`{order}`").alias("order"),
        F.col(f"`{source}`").alias("source"),
        leaf([F.col(f"`{c}`") for c in columns]).alias("leaf"),
        F.struct(F.lit(True).alias("_"), *[F.col(f"`{c}`") for c in carry]).alias("row"),
    )
    per_source = Forest(leaves, ["order"], fanout, local)
    subroots = per_source.roots().select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("leaf"))
    over = Forest(subroots, ["name"], fanout, local).rows().select(F.col("name").alias("tree"), "root", "steps")
    return per_source.rows(over).drop("place")


def proof(steps: str | Column = "steps") -> Column:
    """The siblings' digests, level by level, left to right, as one text."""
    return F.concat_ws("", F.transform(steps, lambda s: F.concat(s["before"], s["after"])))


def folded(own: str | Column, steps: str | Column = "steps") -> Column:
    """The root that a leaf and the siblings of its proof come to."""
    start = F.col(own) if isinstance(own, str) else own
    return F.aggregate(steps, start, lambda h, s: F.sha2(F.concat(s["before"], h, s["after"]).cast("binary"), 256))


def op12_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    """Every document's leaf, roots and proof, and what a tampered copy of every fifth one or so comes to."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    lowered = F.translate("text", UPPER, LOWER)
    changed = leaf([lowered if c == "text" else F.col(c) for c in COLUMNS])
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    rows = manifest(docs.withColumn("tampered", F.when(chosen, changed)), carry=["tampered"])
    again = rows.withColumn("folded_root", folded(F.coalesce("row.tampered", "leaf")))
    return again.select(
        F.col("order").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        F.sha2(proof().cast("binary"), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


OP12_SQL = f"""
WITH RECURSIVE docs AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce('=' || source, '') AS source,
    sha256(a || b || c || d || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN {C.crc32_sql("CAST(doc_id AS VARCHAR)")} % 5 = 0
      THEN sha256(a || b || c || d || coalesce(strlen(text) || ':' || translate(text, '{UPPER}', '{LOWER}'), '-'))
      END AS tampered
  FROM (SELECT doc_id, source, text,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') AS a,
    coalesce(strlen(source) || ':' || source, '-') AS b,
    coalesce(strlen(lang) || ':' || lang, '-') AS c,
    coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS d FROM documents)
), leaves AS MATERIALIZED (
  SELECT r, source, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS k, leaf,
    count(*) OVER (PARTITION BY source) AS n FROM docs
), lower_nodes AS (
  SELECT source, 0 AS l, k, leaf AS h, n FROM leaves
  UNION ALL
  SELECT source, l + 1, k // 16, sha256(string_agg(h, '' ORDER BY k)), (n + 15) // 16
  FROM lower_nodes WHERE n > 1 GROUP BY source, l, n, k // 16
), subroots AS MATERIALIZED (
  SELECT source, h AS subroot, row_number() OVER (ORDER BY source) - 1 AS k, count(*) OVER () AS n
  FROM lower_nodes WHERE n = 1
), upper_nodes AS (
  SELECT 0 AS l, k, subroot AS h, n FROM subroots
  UNION ALL
  SELECT l + 1, k // 16, sha256(string_agg(h, '' ORDER BY k)), (n + 15) // 16
  FROM upper_nodes WHERE n > 1 GROUP BY l, n, k // 16
), sides AS (
  SELECT a.source, a.l, a.k,
    coalesce(string_agg(b.h, '' ORDER BY b.k) FILTER (WHERE b.k < a.k), '') || '|'
      || coalesce(string_agg(b.h, '' ORDER BY b.k) FILTER (WHERE b.k > a.k), '') AS s
  FROM (SELECT source, l, k, h FROM lower_nodes WHERE n > 1 UNION ALL SELECT NULL, l + 100, k, h FROM upper_nodes WHERE n > 1) a
  JOIN (SELECT source, l, k, h FROM lower_nodes WHERE n > 1 UNION ALL SELECT NULL, l + 100, k, h FROM upper_nodes WHERE n > 1) b
    ON a.source IS NOT DISTINCT FROM b.source AND a.l = b.l AND a.k // 16 = b.k // 16
  GROUP BY a.source, a.l, a.k
), paths AS (
  SELECT r, list(s ORDER BY l) AS steps FROM (
    SELECT r, sides.l, s FROM leaves JOIN sides
      ON leaves.source = sides.source AND sides.k = leaves.k // CAST(pow(16, sides.l) AS BIGINT)
    UNION ALL
    SELECT r, sides.l, s FROM leaves JOIN subroots USING (source) JOIN sides
      ON sides.source IS NULL AND sides.k = subroots.k // CAST(pow(16, sides.l - 100) AS BIGINT)
  ) GROUP BY r
), ended AS (
  SELECT doc_id, leaf, subroot, (SELECT h FROM upper_nodes WHERE n = 1) AS root,
    sha256(replace(array_to_string(coalesce(steps, []), ''), '|', '')) AS proof_sha256,
    list_reduce(list_prepend(coalesce(tampered, leaf), coalesce(steps, [])), lambda h, s: sha256(replace(s, '|', h))) AS folded_root
  FROM docs JOIN subroots USING (source) LEFT JOIN paths USING (r)
)
SELECT *, folded_root = root AS verified FROM ended
"""
