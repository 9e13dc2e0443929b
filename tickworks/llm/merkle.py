"""Merkle manifest of a dataset: bitmap-rank leaf coordinates and keyed slot arrays.

Every row is a leaf, the hash of its fields. The leaves of one source, ascending by
doc_id, are reduced 16 at a time to the source's subroot; the subroots, ordered by
source, are reduced likewise to the root.

* Bitmaps: ids of a source are set in 64-bit words; tasks merge words by ``bit_or``, and
  the words of ``2 ** CHUNK`` ids make one compressed container: a mask of the words that are
  not empty, those words, and a popcount directory (rows before each word).
* Ranks: containers get the rows before them from a directory of three levels (65,536
  children each, so no window gathers a source). A leaf's place is the rows before its
  container, those before its word and the popcount below its bit: nothing is sorted by id.
* Slot arrays: 256 neighbouring slots of a tree are one array under the key (tree, slot
  div 256), which two levels of hashes reduce to one node of the next table. Sibling
  lists come back down the same arrays, so no row gathers more than 256 nodes.

The order of sources comes from range partitions: the row number within a partition
plus the rows of the partitions before it.

Nulls: a null field hashes as ``-``; null sources are one tree, the first; null ids
come before all others of their source. Rows that share source and id (nulls too) are
ordered by leaf; equal leaves are interchangeable, and each is a leaf of its own. Such rows
get their places from counts by digest prefix, so a hot id is spread too. Empty and very
long texts are whole fields. Other columns are ignored. An empty table has no leaves, no
root and an empty result. Ids are integers of at most 64 bits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
RUN, SLOTS = 16, 256
CHUNK, BRANCH = 12, 16
ROWS_LATER = 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOCAL = (1 << 33) - 1  # monotonically_increasing_id(): partition above these bits, row number within it


# -- leaves -------------------------------------------------------------------
def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field, fields)), 256)


def lower_cased(docs: DataFrame) -> Column:
    """The tampering that ``manifest`` tests by default: every fifth id by hash has its text's A-Z lowered."""
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return F.when(hit & F.col("text").isNotNull(), F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))


def leaves(docs: DataFrame, tampered_text: Column) -> DataFrame:
    """(tree, doc_id, leaf, tampered, tag): tree is "0" for null sources and "1" before the name of others."""
    own = [F.col(c) for c in FIELDS]
    leaf = leaf_hash(own)
    return docs.select(
        F.coalesce(F.concat(F.lit("1"), F.col("source").cast("string")), F.lit("0")).alias("tree"),
        F.col("doc_id").cast("bigint").alias("doc_id"), leaf.alias("leaf"),
        F.when(tampered_text.eqNullSafe(F.col("text")), leaf).otherwise(leaf_hash([*own[:-1], tampered_text])).alias("tampered"),
        F.monotonically_increasing_id().alias("tag"))


# -- ranks --------------------------------------------------------------------
def one_at(bit: Column) -> Column:
    """1 shifted to a bit that is a column."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), bit.cast("int"))


def below(bit: Column) -> Column:
    """All bits under one."""
    return F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("bigint"), bit.cast("int")))


def id_parts() -> dict[str, Column]:
    at = F.col("doc_id")
    return {"chunk": F.shiftright(at, CHUNK), "word": F.shiftright(at, 6).bitwiseAND(63).cast("int"), "bit": at.bitwiseAND(63).cast("int")}


def running(values: Column) -> Column:
    """Sums of the values before each one."""
    return F.aggregate(values, F.struct(F.lit(0).cast("bigint").alias("sum"), F.array().cast("array<bigint>").alias("out")),
                       lambda a, v: F.struct((a["sum"] + v).alias("sum"), F.array_append(a["out"], a["sum"]).alias("out")),
                       lambda a: a["out"])


def before(over: Window, rows: Column) -> Column:
    return F.coalesce(F.sum(rows).over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def containers(rows: DataFrame) -> DataFrame:
    """(tree, chunk, base, present, words, before, repeats): the merged bitmaps with their directories.

    ``base`` counts the rows of the source with a null id or in an earlier container,
    ``before`` those of the container in earlier words; ``repeats`` lists the ids that
    occur again (their low bits and how often more).
    """
    keyed = rows.where("doc_id is not null").withColumns(id_parts())
    words = stored(keyed.groupBy("tree", "chunk", "word").agg(F.bit_or(one_at(F.col("bit"))).alias("bits"), F.count("*").alias("n")), "merkle-words")
    packed = (words.groupBy("tree", "chunk").agg(F.array_sort(F.collect_list(F.struct("word", "bits", "n"))).alias("w"))
              .select("tree", "chunk", F.aggregate("w", F.lit(0).cast("bigint"), lambda a, x: a.bitwiseOR(one_at(x["word"]))).alias("present"),
                      F.col("w.bits").alias("words"), running(F.col("w.n")).alias("before"),
                      F.aggregate("w.n", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("rows"),
                      F.shiftright("chunk", BRANCH).alias("middle"), F.shiftright("chunk", 2 * BRANCH).alias("top")))
    packed = stored(packed, "merkle-bitmaps")
    middle = packed.groupBy("tree", "top", "middle").agg(F.sum("rows").alias("rows"))
    top = middle.groupBy("tree", "top").agg(F.sum("rows").alias("rows"))
    nulls = rows.where("doc_id is null").groupBy("tree").agg(F.count("*").alias("nulls"))
    top = top.withColumn("over_top", before(Window.partitionBy("tree").orderBy("top"), F.col("rows"))).drop("rows")
    middle = middle.withColumn("over_middle", before(Window.partitionBy("tree", "top").orderBy("middle"), F.col("rows"))).drop("rows")
    own = packed.withColumn("own", before(Window.partitionBy("tree", "top", "middle").orderBy("chunk"), F.col("rows")))
    out = (own.join(middle, ["tree", "top", "middle"]).join(top, ["tree", "top"]).join(nulls, "tree", "left")
           .withColumn("base", F.col("own") + F.col("over_middle") + F.col("over_top") + F.coalesce("nulls", F.lit(0))))
    twice = words.where(F.col("n") > F.bit_count("bits")).select("tree", "chunk", "word")
    again = (keyed.join(twice, ["tree", "chunk", "word"], "left_semi").groupBy("tree", "chunk", "word", "bit").agg((F.count("*") - 1).alias("more"))
             .where("more > 0").groupBy("tree", "chunk").agg(F.collect_list(F.struct("word", "bit", "more")).alias("repeats")))
    return out.join(again, ["tree", "chunk"], "left").select("tree", "chunk", "base", "present", "words", "before", "repeats")


def rank(word: Column, bit: Column) -> Column:
    """Rows of the source before the id with these low bits: directory, word, popcount, repeats."""
    at = F.bit_count(F.col("present").bitwiseAND(below(word))).cast("int")
    own = F.get("words", at).bitwiseAND(below(bit))
    more = F.aggregate(F.filter("repeats", lambda x: (x["word"] == word) & (x["bit"] < bit)), F.lit(0).cast("bigint"), lambda a, x: a + x["more"])
    return F.col("base") + F.get("before", at) + F.bit_count(own) + F.coalesce(more, F.lit(0))


def slots(rows: DataFrame) -> DataFrame:
    """``rows`` with ``slot``, the place of a leaf in its tree."""
    found = stored(containers(rows), "merkle-directory")
    placed = (rows.withColumns(id_parts()).join(found, ["tree", "chunk"], "left")
              .withColumn("slot", F.coalesce(rank(F.col("word"), F.col("bit")), F.lit(0)))
              .withColumn("shared", F.col("doc_id").isNull() | F.coalesce(
                  F.exists("repeats", lambda x: (x["word"] == F.col("word")) & (x["bit"] == F.col("bit"))), F.lit(False)))
              .select(*rows.columns, "slot", "shared"))
    if found.where("repeats is not null").isEmpty() and rows.where("doc_id is null").isEmpty():
        return placed.drop("shared")
    placed = stored(placed, "merkle-places")
    # rows of one id: by digest prefix, then by digest and a slice of the stored row numbers, then within the slice
    one = ["tree", "slot"]
    odd = placed.where("shared").withColumn("prefix", F.substring("leaf", 1, 3)).withColumn("slice", F.shiftright("tag", ROWS_LATER))
    by_prefix = odd.groupBy(*one, "prefix").agg(F.count("*").alias("n"))
    by_prefix = by_prefix.withColumn("a", before(Window.partitionBy(*one).orderBy("prefix"), F.col("n"))).drop("n")
    by_leaf = odd.groupBy(*one, "prefix", "leaf", "slice").agg(F.count("*").alias("n"))
    by_leaf = by_leaf.withColumn("b", before(Window.partitionBy(*one, "prefix").orderBy("leaf", "slice"), F.col("n"))).drop("n")
    c = F.row_number().over(Window.partitionBy(*one, "prefix", "leaf", "slice").orderBy("tag")) - 1
    odd = (odd.withColumn("c", c).join(by_prefix, [*one, "prefix"]).join(by_leaf, [*one, "prefix", "leaf", "slice"])
           .withColumn("slot", F.col("slot") + F.col("a") + F.col("b") + F.col("c")))
    return placed.where("not shared").drop("shared").unionByName(odd.select(*rows.columns, "slot"))


# -- trees --------------------------------------------------------------------
def slot_arrays(nodes: DataFrame, sizes: DataFrame, payload: list[str]) -> DataFrame:
    """(tree, part, n, row, digests, parents): 256 slots under one key, and the hashes of their runs of 16.

    ``digests`` are in slot order; ``parents`` is empty where the tree has one node.
    """
    row = F.array_sort(F.collect_list(F.struct("slot", *payload)))
    arrays = (nodes.withColumn("part", F.shiftright("slot", 8)).groupBy("tree", "part").agg(row.alias("row"))
              .join(sizes, "tree").withColumn("digests", F.col("row." + payload[0])))
    parents = F.transform(F.sequence(F.lit(0), ((F.size("digests") - 1) / RUN).cast("int")),
                          lambda k: F.sha2(F.array_join(F.slice("digests", k * RUN + 1, F.lit(RUN)), ""), 256))
    return arrays.withColumn("parents", F.when(F.col("n") > 1, parents).otherwise(F.array().cast("array<string>")))


def tops(arrays: DataFrame) -> DataFrame:
    """(tree, slot, digest): the one node that two levels make of an array."""
    top = (F.when(F.col("n") == 1, F.col("digests")[0]).when(F.col("n") <= RUN, F.col("parents")[0])
           .otherwise(F.sha2(F.array_join("parents", ""), 256)))
    return arrays.select("tree", F.col("part").alias("slot"), top.alias("digest"))


def reduced(nodes: DataFrame, sizes: DataFrame, payload: list[str], most: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """(arrays of each round, the one node of each tree); ``most`` is the size of the largest tree."""
    rounds = []
    while True:
        rounds.append(stored(slot_arrays(nodes, sizes, payload), f"merkle-{name}"))
        nodes, payload = tops(rounds[-1]), ["digest"]
        if most <= SLOTS:
            return rounds, nodes
        most = -(-most // SLOTS)
        sizes = sizes.select("tree", F.ceil(F.col("n") / SLOTS).cast("bigint").alias("n"))


def own_path(i: Column) -> Column:
    """[(left, right) siblings] of slot ``i`` of an array, one entry a level."""
    run, at = (i / RUN).cast("int"), i % RUN
    join = lambda x: F.array_join(x, "")
    first = F.struct(join(F.slice("digests", run * RUN + 1, at)).alias("left"),
                     join(F.slice("digests", i + 2, RUN - 1 - at)).alias("right"))
    second = F.struct(join(F.slice("parents", F.lit(1), run)).alias("left"), join(F.slice("parents", run + 2, F.lit(RUN))).alias("right"))
    return (F.when(F.col("n") == 1, F.array().cast("array<struct<left:string,right:string>>"))
            .when(F.col("n") <= RUN, F.array(first)).otherwise(F.array(first, second)))


def with_paths(arrays: DataFrame, upper: DataFrame) -> DataFrame:
    """A row for each slot of ``arrays``: its entry, all of its siblings up to the root, and what ``upper`` has besides.

    ``upper`` has (tree, slot, path, ...) of the nodes above.
    """
    up = upper.withColumnRenamed("slot", "part").withColumnRenamed("path", "above")
    rest = [c for c in up.columns if c not in ("tree", "part", "above")]
    each = arrays.join(up, ["tree", "part"]).withColumn("i", F.explode(F.sequence(F.lit(0), F.size("digests") - 1)))
    return each.select("tree", F.get("row", F.col("i")).alias("entry"), F.concat(own_path(F.col("i")), "above").alias("path"), *rest)


def paths_down(rounds: list[DataFrame], upper: DataFrame, last: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Siblings handed down from the topmost arrays; ``last`` makes the result of the lowest."""
    for k, arrays in enumerate(rounds[::-1]):
        found = with_paths(arrays, upper)
        if k == len(rounds) - 1:
            return last(found)
        upper = found.select("tree", F.col("entry.slot").alias("slot"), *[c for c in found.columns if c not in ("tree", "entry")])
    raise ValueError("a tree has at least one round")


def numbered(subroots: DataFrame) -> DataFrame:
    """(source_tree, digest, slot): subroots in order of source."""
    ranged = subroots.repartitionByRange(partitions(subroots), "tree").sortWithinPartitions("tree")
    held = stored(ranged.select(F.col("tree").alias("source_tree"), "digest", F.monotonically_increasing_id().alias("at")), "merkle-sources")
    held = held.withColumn("range", F.shiftright("at", 33)).withColumn("at", F.col("at").bitwiseAND(LOCAL))
    # one row for each range partition
    starts = held.groupBy("range").agg(F.count("*").alias("n")).withColumn("start", before(Window.orderBy("range"), F.col("n")))
    return held.join(starts, "range").select("source_tree", "digest", (F.col("start") + F.col("at")).alias("slot"))


def manifest(docs: DataFrame, tampered_text: Column | None = None) -> DataFrame:
    """(source, doc_id, slot, leaf, tampered, subroot, root, path): a row a leaf.

    ``path`` has the siblings (left, right) at each level from the leaf to the root;
    ``tampered`` is the leaf of the row with ``tampered_text`` (``lower_cased`` by default).
    """
    rows = stored(leaves(docs, lower_cased(docs) if tampered_text is None else tampered_text), "merkle-leaves")
    sizes = stored(rows.groupBy("tree").agg(F.count("*").alias("n")), "merkle-sizes")
    most, sources = sizes.agg(F.max("n"), F.count("*")).first()
    placed = slots(rows)
    below, subroots = reduced(placed, sizes, ["leaf", "tampered", "doc_id"], most or 0, "leaves")
    above, root = reduced(numbered(subroots).withColumn("tree", F.lit("root")),
                          docs.sparkSession.range(1).select(F.lit("root").alias("tree"), F.lit(sources).cast("bigint").alias("n")),
                          ["digest", "source_tree"], sources, "sources")
    start = root.select("tree", "slot", F.col("digest").alias("root"), F.array().cast("array<struct<left:string,right:string>>").alias("path"))
    by_source = stored(paths_down(above, start, lambda x: x.select(
        F.col("entry.source_tree").alias("tree"), F.lit(0).cast("bigint").alias("slot"), "path", "root",
        F.col("entry.digest").alias("subroot"))), "merkle-upper")
    return paths_down(below, by_source, lambda x: x.select(
        F.when(F.col("tree") != "0", F.substring("tree", 2, 1 << 30)).alias("source"), "entry.doc_id", "entry.slot",
        "entry.leaf", "entry.tampered", "subroot", "root", "path"))


def verified_leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row."""
    proof = F.sha2(F.array_join(F.transform("path", lambda x: F.concat(x["left"], x["right"])), ""), 256)
    folded = F.aggregate("path", F.col("tampered"), lambda h, x: F.sha2(F.concat(x["left"], h, x["right"]), 256))
    out = manifest(docs).withColumn("proof_sha256", proof).withColumn("folded_root", folded)
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def field_sql(value: str) -> str:
    return f"coalesce(octet_length(encode(CAST({value} AS VARCHAR))) || ':' || CAST({value} AS VARCHAR), '-')"


#: The same rows in SQL by row numbers; ids are unique within a source there. 3988292384 is the polynomial of CRC-32.
ORACLE_SQL = f"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END)) AS t),
crc AS (
  SELECT d.doc_id AS id, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(string_split(CAST(d.doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda c, b: xor(c // 256, t[(xor(c, b) % 256) + 1]))) % 5 = 0 AS hit FROM documents d, crc_table),
leaf AS (
  SELECT d.doc_id, coalesce('1' || source, '0') AS tree,
    sha256({' || '.join(map(field_sql, FIELDS))}) AS leaf,
    CASE WHEN hit THEN sha256({' || '.join(map(field_sql, FIELDS[:-1]))} || {field_sql(f"translate(text, '{UPPER}', '{LOWER}')")})
      ELSE sha256({' || '.join(map(field_sql, FIELDS))}) END AS tampered,
    row_number() OVER (PARTITION BY source ORDER BY d.doc_id) - 1 AS slot, count(*) OVER (PARTITION BY source) AS n
  FROM documents d JOIN crc c ON c.id = d.doc_id),
nodes AS (
  SELECT tree, 0 AS level, slot, leaf AS digest, n FROM leaf
  UNION ALL
  SELECT tree, level + 1, slot // {RUN}, sha256(string_agg(digest, '' ORDER BY slot)), (n + {RUN - 1}) // {RUN}
  FROM nodes WHERE n > 1 GROUP BY tree, level, slot // {RUN}, n),
subs AS (
  SELECT tree, digest, level AS depth, row_number() OVER (ORDER BY tree) - 1 AS slot, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, slot, digest, n FROM subs
  UNION ALL
  SELECT level + 1, slot // {RUN}, sha256(string_agg(digest, '' ORDER BY slot)), (n + {RUN - 1}) // {RUN}
  FROM tops WHERE n > 1 GROUP BY level, slot // {RUN}, n),
sib AS (
  SELECT l.doc_id, l.tree, l.slot AS leaf_slot, x.level, x.slot, x.digest, l.slot // CAST(power({RUN}, x.level) AS BIGINT) AS own
  FROM leaf l JOIN nodes x ON x.tree = l.tree AND x.n > 1 AND x.slot // {RUN} = l.slot // CAST(power({RUN}, x.level + 1) AS BIGINT)
  UNION ALL
  SELECT l.doc_id, l.tree, l.slot, s.depth + x.level, x.slot, x.digest, s.slot // CAST(power({RUN}, x.level) AS BIGINT)
  FROM leaf l JOIN subs s ON s.tree = l.tree JOIN tops x ON x.n > 1 AND x.slot // {RUN} = s.slot // CAST(power({RUN}, x.level + 1) AS BIGINT)),
sides AS (
  SELECT doc_id, tree, level, coalesce(string_agg(digest, '' ORDER BY slot) FILTER (slot < own), '') AS l,
    coalesce(string_agg(digest, '' ORDER BY slot) FILTER (slot > own), '') AS r FROM sib GROUP BY doc_id, tree, level),
proofs AS (SELECT doc_id, tree, string_agg(l || r, '' ORDER BY level) AS proof, count(*) AS levels FROM sides GROUP BY doc_id, tree),
fold AS (
  SELECT doc_id, tree, 0 AS level, tampered AS h FROM leaf
  UNION ALL
  SELECT f.doc_id, f.tree, f.level + 1, sha256(s.l || f.h || s.r) FROM fold f JOIN sides s USING (doc_id, tree, level)),
root AS (SELECT digest FROM tops WHERE n = 1)
SELECT l.doc_id, l.leaf, s.digest AS subroot, r.digest AS root, sha256(coalesce(p.proof, '')) AS proof_sha256,
       f.h AS folded_root, f.h = r.digest AS verified
FROM leaf l JOIN subs s USING (tree) CROSS JOIN root r LEFT JOIN proofs p USING (doc_id, tree)
JOIN fold f ON f.doc_id = l.doc_id AND f.tree = l.tree AND f.level = coalesce(p.levels, 0)
"""
