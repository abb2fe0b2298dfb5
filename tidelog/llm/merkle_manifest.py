"""Operator 11: a Merkle manifest of a table, with a proof for every row.

Each row's digest is a leaf; per source, leaves stand in the order of their
doc_id and 16 neighbours make one node, level by level, up to the source's
subroot; the subroots, in the order of their sources, make the root alike.

Places come from bitmaps, not from sorting the leaves.  A source's doc_ids
are a bitmap kept as its non-zero 64-bit words: tasks set bits of the words
they meet, and words of one place are merged by OR in the shuffle, map-side
first.  A directory of four levels (prefixes of the word number) holds the
counts before each word, so that no window sees over 32,768 rows whatever
the ids are.  The rank of a doc_id is the count before its word plus the bits
set below its own.  The rank gives the run (rank / 16) and the slot in it;
rows meet in the array of 16 slots of their run, whose digest is the node of
the next level.  Every shuffle key is a word, a run or finer, so that a
source with a third of all rows is spread like the others.

Proofs go from the root down: a node's way up (what stands left and right of
it on each level) is made once and shared by the 16 nodes below it.

Defined cases: a null doc_id stands first, before the smallest number; it is
never tampered with.  Rows with one source and doc_id ascend by their leaf
digest; of equal rows each has its own place.  A null source is a source of
its own, before all others.  A null text can be tampered with without effect.
An empty table gives an empty result.  Only doc_id, source, lang, n_chars and
text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import id_or_null, materialise, table

FAN = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rows whose decimal doc_id has a CRC-32 divisible by this are tampered with.
TAMPER = 5
#: Bits of the word number that each level of the directory leaves out.
PREFIXES = (15, 15, 14)
#: Equal rows that one task puts in their places.
COPIES = 4096
RESULT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def leaf_digest(text: Column) -> Column:
    """Digest of a row's fields, with ``text`` in place of its text."""
    parts = []
    for name in FIELDS:
        c = text if name == "text" else F.col(name).cast("string")
        parts.append(
            F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c))
        )
    return digest(F.concat(*parts))


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, g (the source; sorts as the source does), id, leaf and bad, the
    leaf after tampering, or null."""
    d = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", F.col("n_chars").cast("long"), "text"
    )
    marked = F.crc32(F.col("doc_id").cast("string")) % TAMPER == 0
    return d.select(
        "doc_id",
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("g"),
        id_or_null().alias("id"),
        leaf_digest(F.col("text")).alias("leaf"),
        F.when(marked, leaf_digest(F.translate("text", UPPER, LOWER))).alias("bad"),
    )


# ------------------------------------------------------------ bitmaps and ranks


def bitmap_words(rows: DataFrame) -> DataFrame:
    """g, w, bits and n: the non-zero words of each group's bitmap of ids, and
    the rows behind each word."""
    bit = F.expr("shiftleft(1L, cast(id & 63 as int))")
    return rows.groupBy("g", F.shiftright("id", 6).alias("w")).agg(
        F.bit_or(bit).alias("bits"), F.count(F.lit(1)).alias("n")
    )


def directory(words: DataFrame) -> DataFrame:
    """``words`` with before: the rows of the group that precede the word."""
    levels = [words]
    for shift in PREFIXES:
        lower = levels[-1]
        key = F.shiftright("w", shift).alias("w")
        levels.append(lower.groupBy("g", key).agg(F.sum("n").alias("n")))
    above = None
    for level in reversed(range(len(levels))):
        rows = levels[level]
        if above is None:
            within = Window.partitionBy("g").orderBy("w")
            base = F.lit(0).cast("long")
        else:
            up = F.shiftright("w", PREFIXES[level])
            rows = rows.withColumn("up", up).join(
                above.select("g", F.col("w").alias("up"), F.col("before").alias("base")), ["g", "up"]
            )
            within = Window.partitionBy("g", "up").orderBy("w")
            base = F.col("base")
        earlier = F.coalesce(F.sum("n").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        above = rows.withColumn("before", base + earlier).select(*levels[level].columns, "before")
    return above


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` with at, the place (from 0) of each in its group by id."""
    words = materialise(bitmap_words(rows), "bitmap-words")
    found = directory(words)
    w = rows.withColumn("w", F.shiftright("id", 6)).join(found, ["g", "w"])
    single = F.bit_count("bits") == F.col("n")
    below = F.expr("bits & ~shiftleft(-1L, cast(id & 63 as int))")
    columns = [*rows.columns, "at"]
    alone = w.where(single).withColumn("at", F.col("before") + F.bit_count(below)).select(*columns)
    if words.where(~single).isEmpty():
        return alone
    return alone.unionByName(ranked_repeats(w.where(~single)).select(*columns))


def ranked_repeats(rows: DataFrame) -> DataFrame:
    """Places of rows whose word holds an id of several rows.

    Rows of one id are counted by the first digits of their leaf, so that the
    places of an id with very many rows come from many tasks too; equal rows
    are counted and then given their places in blocks.
    """
    keys = ["g", "w", "before", "id", "doc_id", "leaf", "bad"]
    distinct = materialise(
        rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).withColumn("digits", F.substring("leaf", 1, 4)),
        "repeated-ids",
    )

    def before(df, partition, order, count):
        over = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(count).over(over), F.lit(0))

    by_digits = distinct.groupBy("g", "w", "id", "digits").agg(F.sum("copies").alias("n"))
    by_id = by_digits.groupBy("g", "w", "id").agg(F.sum("n").alias("n"))
    by_id = by_id.select("g", "id", before(by_id, ["g", "w"], "id", "n").alias("of_id"))
    by_digits = by_digits.join(by_id, ["g", "id"]).select(
        "g", "id", "digits", (F.col("of_id") + before(by_digits, ["g", "id"], "digits", "n")).alias("of_digits")
    )
    placed = distinct.join(by_digits, ["g", "id", "digits"]).withColumn(
        "first", F.col("before") + F.col("of_digits") + before(distinct, ["g", "id", "digits"], "leaf", "copies")
    )
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES).cast("long")))
    blocks = placed.withColumn("from", block).repartition("g", "id", "leaf", "from")
    last = F.least(F.col("from") + COPIES, "copies") - 1
    return blocks.withColumn("i", F.explode(F.sequence("from", last))).withColumn("at", F.col("first") + F.col("i"))


def in_order(df: DataFrame, key: str) -> DataFrame:
    """``df`` with at, the place of each row by ``key``, which is unique: range
    partitions are numbered within, and offset by the counts before them."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(parts, key).sortWithinPartitions(key)
    numbered = materialise(dealt.withColumn("mid", F.monotonically_increasing_id()), "ordered")
    numbered = numbered.withColumn("part", F.shiftright("mid", 33))
    # one row for each partition
    counts = numbered.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    over = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("offset"))
    within = F.col("mid") - F.shiftleft("part", 33)
    return numbered.join(F.broadcast(offsets), "part").withColumn("at", F.col("offset") + within).select(
        *df.columns, "at"
    )


# ------------------------------------------------------------ levels


def slot_arrays(nodes: DataFrame, *carried: str) -> DataFrame:
    """Nodes (g, at, digest) in arrays by run, with the run's own digest."""
    slot = F.col("at").bitwiseAND(FAN - 1).cast("int").alias("slot")
    runs = nodes.groupBy("g", F.shiftright("at", 4).alias("run")).agg(
        F.sort_array(F.collect_list(F.struct(slot, "digest", *carried))).alias("slots")
    )
    return runs.withColumn("node", digest(F.array_join("slots.digest", "")))


#: A run that is all of its group: its one node is the group's root.
FINISHED = "run = 0 AND size(slots) = 1"
UNFINISHED = f"NOT ({FINISHED})"


def reduce_levels(nodes: DataFrame, *carried: str) -> list[DataFrame]:
    """The written slot arrays of every level; the last has finished runs only."""
    levels = [materialise(slot_arrays(nodes, *carried), "merkle-level-0")]
    while not (rest := levels[-1].where(UNFINISHED)).isEmpty():
        up = rest.select("g", F.col("run").alias("at"), F.col("node").alias("digest"))
        levels.append(materialise(slot_arrays(up), f"merkle-level-{len(levels)}"))
    return levels


def roots(levels: list[DataFrame]) -> DataFrame:
    """g and digest of every group's root."""
    out = None
    for level in levels:
        done = level.where(FINISHED).select("g", F.get("slots.digest", F.lit(0)).alias("digest"))
        out = done if out is None else out.unionByName(done)
    return out


def ways_up(levels: list[DataFrame], tops: DataFrame | None = None) -> DataFrame:
    """Every node of the first level with what ``tops`` (g, way, ...) says of
    its group, the way extended down to the node.  Without ``tops`` the ways
    begin at the groups' roots.

    A way is an array, from the node up, of what stands left (l) and right
    (r) of the node, or of its ancestor, within the run.
    """
    extra = [c for c in tops.columns if c not in ("g", "way")] if tops is not None else []
    start = F.expr("cast(array() as array<struct<l:string,r:string>>)")
    below = None
    for number in reversed(range(len(levels))):
        level = levels[number]
        done = level.where(FINISHED)
        done = done.withColumn("way", start) if tops is None else done.join(tops, "g")
        done = done.select(
            "g", F.lit(0).cast("long").alias("at"), F.get("slots", F.lit(0)).alias("slot"), "way", *extra
        )
        if below is None:
            below = done
            continue
        runs = level.where(UNFINISHED).join(below.drop("slot").withColumnRenamed("at", "run"), ["g", "run"])
        digests = F.col("slots.digest")
        left = F.array_join(F.slice(digests, F.lit(1), F.col("pos")), "")
        right = F.array_join(F.slice(digests, F.col("pos") + 2, F.lit(FAN)), "")
        spread = runs.select("g", "run", "slots", "way", *extra, F.posexplode("slots").alias("pos", "slot"))
        below = spread.select(
            "g",
            (F.col("run") * FAN + F.col("pos")).alias("at"),
            "slot",
            F.concat(F.array(F.struct(left.alias("l"), right.alias("r"))), "way").alias("way"),
            *extra,
        ).unionByName(done)
    return below


def merkle_manifest(docs: DataFrame) -> DataFrame:
    """Leaf, subroot, root, proof and the check of the proof for every row."""
    spark = docs.sparkSession
    base = materialise(leaves(docs), "merkle-leaves")
    if base.isEmpty():
        return spark.createDataFrame([], RESULT)
    nodes = ranked(base).withColumnRenamed("leaf", "digest")
    levels = reduce_levels(nodes, "doc_id", "bad")
    subroots = in_order(materialise(roots(levels), "subroots"), "g")
    top = reduce_levels(subroots.select(F.lit("").alias("g"), "at", "digest", F.col("g").alias("of")), "of")
    root = roots(top).first()["digest"]
    tops = ways_up(top).select(
        F.col("slot.of").alias("g"), "way", F.col("slot.digest").alias("subroot")
    )
    rows = ways_up(levels, tops).select("slot.*", "way", "subroot").withColumnRenamed("digest", "leaf")
    proof = digest(F.array_join(F.transform("way", lambda x: F.concat(x.l, x.r)), ""))
    folded = F.aggregate("way", F.coalesce("bad", "leaf"), lambda node, x: digest(F.concat(x.l, node, x.r)))
    return rows.select(
        "doc_id", "leaf", "subroot", F.lit(root).alias("root"), proof.alias("proof_sha256"), folded.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def query(spark, sf_dir):
    return merkle_manifest(table(spark, sf_dir, "documents"))


def oracle_sql(levels: int = 6, top_levels: int = 4) -> str:
    """For up to 16**levels rows of a source and 16**top_levels sources."""

    def h(text):
        return f"sha256({text})"

    def field(c, text=None):
        c = text or f"CAST({c} AS VARCHAR)"
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}) || ':' || {c} END"

    def leaf(text):
        return h(" || ".join([field(c) for c in FIELDS[:-1]] + [field("text", text)]))

    crc = (
        "list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
        "lambda c: ascii(c)::UBIGINT)), lambda a, b: list_reduce(list_prepend(xor(a, b), "
        "list_transform(range(8), lambda i: 0::UBIGINT)), "
        "lambda x, y: xor(x >> 1, (x & 1) * 3988292384::UBIGINT)))"
    )
    parts = [
        f"""leaves AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, source, {leaf("text")} AS leaf,
         CASE WHEN xor({crc}, 4294967295::UBIGINT) % {TAMPER} = 0
              THEN {leaf(f"translate(text, '{UPPER}', '{LOWER}')")} END AS bad
  FROM documents)""",
        """n0 AS MATERIALIZED (
  SELECT r, source AS g, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS place,
         leaf AS digest FROM leaves)""",
    ]

    def climb(name, count):
        for k in range(count):
            parts.append(
                f"""{name}r{k} AS MATERIALIZED (
  SELECT g, place // {FAN} AS run, list(digest ORDER BY place) AS digests,
         (SELECT count(*) FROM {name}{k} o WHERE o.g IS NOT DISTINCT FROM t.g) = 1 AS done
  FROM {name}{k} t GROUP BY g, place // {FAN})"""
            )
            parts.append(
                f"""{name}{k + 1} AS MATERIALIZED (
  SELECT g, run AS place, CASE WHEN done THEN digests[1] ELSE sha256(array_to_string(digests, '')) END AS digest
  FROM {name}r{k})"""
            )

    def ways(name, count, rows):
        """From rows (key, g, place) of the first level: lists of left and right parts."""
        parts.append(f"{name}w0 AS MATERIALIZED (SELECT *, place AS p, []::VARCHAR[] AS l, []::VARCHAR[] AS r2 FROM ({rows}))")
        for k in range(count):
            parts.append(
                f"""{name}w{k + 1} AS MATERIALIZED (
  SELECT w.* EXCLUDE (p, l, r2), w.p // {FAN} AS p,
         CASE WHEN done THEN l ELSE l || [array_to_string(digests[1:w.p % {FAN}], '')] END AS l,
         CASE WHEN done THEN r2 ELSE r2 || [array_to_string(digests[w.p % {FAN} + 2:], '')] END AS r2
  FROM {name}w{k} w JOIN {name}r{k} n ON w.g IS NOT DISTINCT FROM n.g AND w.p // {FAN} = n.run)"""
            )

    climb("n", levels)
    parts.append(
        f"""t0 AS MATERIALIZED (
  SELECT 0 AS g, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS place, digest, g AS source FROM n{levels})"""
    )
    climb("t", top_levels)
    ways("n", levels, "SELECT r, g, place FROM n0")
    ways("t", top_levels, "SELECT source, g, place, digest AS subroot FROM t0")
    fold = "list_reduce(list_prepend(coalesce(bad, leaf), list_transform(list_zip(l, r2), lambda z: z[1] || '|' || z[2])), lambda a, b: sha256(replace(b, '|', a)))"
    return "WITH " + ",\n".join(parts) + f"""
SELECT *, folded_root = root AS verified FROM (
  SELECT doc_id, leaf, subroot, (SELECT digest FROM t{top_levels}) AS root,
         sha256(array_to_string(list_transform(list_zip(l, r2), lambda z: z[1] || z[2]), '')) AS proof_sha256,
         {fold} AS folded_root
  FROM (SELECT doc_id, leaf, bad, subroot, n.l || t.l AS l, n.r2 || t.r2 AS r2
        FROM leaves JOIN nw{levels} n USING (r) JOIN tw{top_levels} t ON n.g IS NOT DISTINCT FROM t.source))
"""
