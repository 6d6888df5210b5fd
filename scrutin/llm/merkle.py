"""Operator 12: a Merkle manifest of a dataset, and inclusion proofs by a recursive query.

Every row is a leaf digest.  The leaves of a source, by id, form a tree of
fan-out 3; the sources' roots form the top tree in the same way.  Four levels
are built at a time: a written link row stands for a node, holds the digests
below it layer by layer (81 at most in the lowest, 120 in all), and names its
own parent link.  A Spark recursive query then climbs from the leaves: each
step joins the parent link, appends the siblings of its layers to the proof,
and folds every leaf's digest, which may come from changed content, with those
siblings.  The up to 81 leaves of a lowest link go the same way from there on,
so they climb as one row that holds a folded digest for each of them and one
proof, which each leaf's own siblings inside the link precede in the end.

From the link level on at which at most BROADCAST_LINKS / 2 links are left
(about 5 kB each) links are broadcast, since there one link serves up to all
leaves of a source; larger levels, whose links serve 81 rows or few more,
are joined by a shuffle.  If there are that many sources, the low levels of the
top tree are joined by shuffle in SALTS copies, since one source may have most
leaves.  Each phase's rows are written before the next one.

Defined cases: null fields count as ``-``; an empty text is ``0:``.  Equal ids
are ordered by their leaf's digest, null ids come first; equal rows are leaves
of their own.  A source of one leaf has that leaf as its root, a table of one
source has no top tree.  An empty table has no rows.  A null id is not tampered
with.  Columns beside those named are not read, whatever their names.  A text
is only hashed, so its length has no bound of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrutin.llm.common import stored
from scrutin.llm.ranks import positions

FAN_OUT = 3
LAYERS = 4
BLOCK = FAN_OUT ** LAYERS
BROADCAST_LINKS = 4_000
SALTS = 32

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_TOP = "t"
_ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def sha(text: Column) -> Column:
    """The SHA-256 digest of a string as 32 bytes."""
    return F.unhex(F.sha2(text.cast("binary"), 256))


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_digest(fields: list[Column]) -> Column:
    return sha(F.concat(*[field(c) for c in fields]))


def without_line_breaks(documents: DataFrame) -> Column:
    """A changed text for every document whose id's crc32 is even: its line breaks are gone."""
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return F.when(even, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


def leaves(documents: DataFrame, tampered: Column | None = None) -> DataFrame:
    """One row per document: its tree, id, digest, and the digest with the changed text."""
    whole = [F.col(c) for c in FIELDS]
    leaf = leaf_digest(whole)
    other = leaf if tampered is None else F.when(tampered.eqNullSafe(F.col("text")), leaf).otherwise(leaf_digest([*whole[:-1], tampered]))
    # "n" and "s..." keep the order of sources: null first, then by UTF-8 bytes
    tree = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n"))
    return documents.select(tree.alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), leaf.alias("leaf"), other.alias("changed"))


_HASH = "unhex(sha2(cast(array_join(transform({0}, d -> lower(hex(d))), '') as binary), 256))"
_RUN = "slice({0}, 3 * ({1} div 3) + 1, 3)"
#: A digest folded with the run of each layer in which it stands, from place ``slot`` of the lowest.
_FOLD = ("aggregate({layers}, named_struct('d', {digest}, 's', cast({slot} as bigint)), (acc, layer) -> named_struct('d', "
         "unhex(sha2(cast(array_join(transform(" + _RUN.format("layer", "acc.s") + ", (d, i) -> lower(hex(if(i = acc.s % 3, acc.d, d)))), '') as binary), 256)), "
         "'s', acc.s div 3)).d")
#: The bytes of the siblings in each layer.
_SIBLINGS = ("unhex(array_join(flatten(transform({layers}, (layer, l) -> transform(filter("
             + _RUN.format("layer", "({slot} div cast(pow(3, l) as bigint))") + ", (d, i) -> i <> ({slot} div cast(pow(3, l) as bigint)) % 3), d -> hex(d)))), ''))")

_UP = ("tree", "level", "pos", "slot")


def _blocks(nodes: DataFrame, level: int, **held: Column) -> DataFrame:
    """Link rows of the trees that have several nodes left: 81 nodes each, as many
    layers as the tree still has, four at most.  ``held``: lists to keep of the nodes."""
    places = F.array_sort(F.collect_list(F.struct("pos", "digest", *[c.alias(k) for k, c in held.items()])))
    links = (nodes.where("n > 1").groupBy("tree", F.expr(f"pos div {BLOCK}").alias("pos"))
             .agg(F.first("n").alias("n"), places.alias("places"))
             .select("tree", "pos", "n", F.lit(level).alias("level"), F.col("places.digest").alias("layer0"), *[F.col(f"places.{k}").alias(k) for k in held]))
    for i in range(1, LAYERS):
        run = _HASH.format(f"slice(layer{i - 1}, {FAN_OUT} * i + 1, {FAN_OUT})")
        links = links.withColumn(f"layer{i}", F.expr(f"if(n > {FAN_OUT ** i}, transform(sequence(0, (size(layer{i - 1}) - 1) div {FAN_OUT}), i -> {run}), null)"))
    layers = [f"layer{i}" for i in range(LAYERS)]
    return (links.withColumn("layers", F.filter(F.array(*layers), lambda x: x.isNotNull())).drop(*layers)
            .withColumn("digest", F.expr(_HASH.format("element_at(layers, -1)")))
            .withColumn("n", F.expr(f"(n + {BLOCK - 1}) div {BLOCK}")))


def _build(nodes: DataFrame, name: str, level: int) -> tuple[list[DataFrame], DataFrame]:
    """The written link levels above ``nodes`` (tree, pos, n, digest), and the last
    node of every tree (tree, digest)."""
    levels, last = [], None
    while True:
        done = nodes.where("n = 1").select("tree", "digest")
        last = done if last is None else last.unionByName(done)
        if nodes.where("n > 1").isEmpty():
            return levels, last
        nodes = stored(_blocks(nodes, level), f"{name}-{level}")
        levels.append(nodes)
        level += 1


def _up(nodes: DataFrame, level: Column) -> DataFrame:
    """The link above each node of its own tree; null for the last node."""
    more = F.col("n") > 1
    return nodes.withColumns({"up_tree": F.when(more, F.col("tree")), "up_level": F.when(more, level), "up_pos": F.when(more, F.expr(f"pos div {BLOCK}")),
                              "up_slot": F.when(more, F.expr(f"cast(pos % {BLOCK} as int)"))})


def manifest(leaf_rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The lowest links with their leaves (doc_ids, changed), and all links above
    them (null: there are none).  Parent-linked: (tree, level, pos) names a link,
    (up_tree, up_level, up_pos) the one above it and up_slot its place there."""
    ranked = stored(positions(leaf_rows, ["tree"], ["doc_id", "leaf"], "merkle-leaves").withColumnRenamed("leaf", "digest"), "merkle-ranked")
    kept = {"doc_ids": F.col("doc_id"), "changed": F.col("changed")}
    # a source's only leaf is a link without layers
    lone = ranked.where("n = 1").select("tree", F.lit(0).cast("long").alias("pos"), F.lit(1).cast("long").alias("n"), F.lit(1).alias("level"), F.array("doc_id").alias("doc_ids"),
                                        F.array("changed").alias("changed"), F.expr("cast(array() as array<array<binary>>)").alias("layers"), "digest")
    low = stored(_blocks(ranked, 1, **kept).unionByName(lone), "merkle-level-1")
    inner, subroots = _build(low.select("tree", "pos", "n", "digest"), "merkle-level", 2)
    subroots = stored(positions(subroots.withColumnRenamed("tree", "own"), [], ["own"], "merkle-subroots").withColumn("tree", F.lit(_TOP)), "merkle-tops")
    upper, _ = _build(subroots, "merkle-top", 1)
    above = _up(subroots, F.lit(1)).select(F.col("own").alias("tree"), *[F.col(f"up_{c}").alias(f"top_{c}") for c in _UP])

    def linked(nodes: DataFrame) -> DataFrame:
        """A source's last node, one for each row of ``above``, goes on into the top tree."""
        nodes = _up(nodes, F.col("level") + 1)
        single = nodes.where("n = 1").join(above, "tree").withColumns({f"up_{c}": F.col(f"top_{c}") for c in _UP}).drop(*[f"top_{c}" for c in _UP])
        return nodes.where("n > 1").unionByName(single)

    links = [linked(x) for x in inner] + [_up(x, F.col("level") + 1) for x in upper]
    if not links:
        return linked(low), None
    every = links[0]
    for x in links[1:]:
        every = every.unionByName(x)
    return linked(low), stored(every.drop("n"), "merkle-links")


_CLIMB = """
WITH RECURSIVE climb(layers, doc_ids, folded, salt, tree, level, pos, slot, proof, subroot, root) MAX RECURSION LEVEL 100 AS (
  SELECT layers, doc_ids, folded, salt, tree, level, pos, slot, proof, subroot, root FROM {rows}
  UNION ALL
  SELECT {hint} c.layers, c.doc_ids, transform(c.folded, f -> {fold}), c.salt, l.up_tree, l.up_level, l.up_pos, l.up_slot,
    concat(c.proof, {siblings}),
    coalesce(c.subroot, CASE WHEN l.tree = 't' AND l.level = 1 THEN l.layers[0][c.slot] END),
    CASE WHEN l.up_tree IS NULL THEN l.digest END
  FROM climb c JOIN {links} l ON c.tree = l.tree AND c.level = l.level AND c.pos = l.pos {salted})
SELECT * FROM climb WHERE root IS NOT NULL OR NOT ({here})
""".replace("{fold}", _FOLD.format(layers="l.layers", digest="f", slot="c.slot")).replace("{siblings}", _SIBLINGS.format(layers="l.layers", slot="c.slot"))


def _phases(counts: list[tuple[bool, int, int]]) -> list[tuple[bool, list[tuple[bool, int]]]]:
    """(broadcast?, link levels) in the order of the climb, from (top tree?, level, links)."""
    out: list[tuple[bool, list[tuple[bool, int]]]] = []
    for top in (False, True):
        mine = sorted(c for c in counts if c[0] == top)
        small = [sum(c[2] for c in mine[i:]) <= BROADCAST_LINKS // 2 for i in range(len(mine))]
        for c, s in zip(mine, small):
            # a broadcast phase goes on into the top tree; shuffles do not
            if out and out[-1][0] == s and (s or out[-1][1][-1][0] == top):
                out[-1][1].append(c[:2])
            else:
                out.append((s, [c[:2]]))
    return out


def climb(low: DataFrame, links: DataFrame | None) -> DataFrame:
    """Every lowest link's leaves with their folded digests at the root, the proof
    above the link, the source's root and the root, by the recursive query.

    The session's row limit for recursive queries is lifted while the phases
    are written, then put back.
    """
    spark = low.sparkSession
    rows = low.select(
        F.expr("if(size(layers) = 0, array(array(digest)), layers)").alias("layers"), "doc_ids",
        F.expr(f"transform(changed, (x, p) -> {_FOLD.format(layers='layers', digest='x', slot='p')})").alias("folded"),
        F.pmod(F.xxhash64("tree", "pos"), F.lit(SALTS)).cast("int").alias("salt"), *[F.col(f"up_{c}").alias(c) for c in _UP],
        F.lit(b"").alias("proof"), F.lit(None).cast("binary").alias("subroot"), F.when(F.col("up_tree").isNull(), F.col("digest")).alias("root"))
    if links is None:
        return rows
    counts = [(r.top, r.level, r["count"]) for r in links.groupBy((F.col("tree") == _TOP).alias("top"), "level").count().collect()]
    before = spark.conf.get(_ROW_LIMIT)
    spark.conf.set(_ROW_LIMIT, "-1")
    try:
        for i, (small, levels) in enumerate(_phases(counts)):
            here = " OR ".join(f"(tree {'=' if top else '<>'} '{_TOP}' AND level = {level})" for top, level in levels)
            mine, salted = links.where(here), ""
            if not small and levels[0][0]:
                mine = mine.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
                salted = "AND c.salt = l.copy"
            sql = _CLIMB.replace("{hint}", "/*+ BROADCAST(l) */" if small else "").replace("{salted}", salted).replace("{here}", here)
            rows = stored(spark.sql(sql, rows=rows, links=mine), f"merkle-climb-{i}")
    finally:
        spark.conf.set(_ROW_LIMIT, before)
    return rows


def proofs(documents: DataFrame, tampered: Column | None = None) -> DataFrame:
    """One row per document: ``doc_id``; ``leaf``, ``subroot``, ``root``, ``folded``
    (32-byte digests); ``proof`` (its siblings' digests, in order); ``verified``."""
    got = climb(*manifest(leaves(documents, tampered)))
    # the place in the lowest link; a lone leaf's single layer holds no sibling
    each = got.select("layers", "subroot", "root", "proof", F.posexplode(F.arrays_zip("doc_ids", "folded")).alias("place", "own"))
    return each.select(F.col("own.doc_ids").alias("doc_id"), F.expr("layers[0][place]").alias("leaf"), F.coalesce("subroot", "root").alias("subroot"), "root",
                       F.concat(F.expr(_SIBLINGS.format(layers="layers", slot="place")), "proof").alias("proof"), F.col("own.folded").alias("folded"),
                       (F.col("own.folded") == F.col("root")).alias("verified"))


def verifications(documents: DataFrame) -> DataFrame:
    """The proofs of all documents, half of them folded from a text that lost its line breaks, as hex text."""
    got = proofs(documents, without_line_breaks(documents))
    hexed = {c: F.lower(F.hex(c)) for c in ("leaf", "subroot", "root")}
    return got.select("doc_id", *[v.alias(c) for c, v in hexed.items()],
                      F.sha2(F.lower(F.hex("proof")).cast("binary"), 256).alias("proof_sha256"),
                      F.lower(F.hex("folded")).alias("folded_root"), "verified")


#: crc32 of a decimal id: eight steps for each byte, 3988292384 is the fixed polynomial.
CRC32 = """
  xor(list_reduce(list_concat([4294967295], [ord(ch) for ch in string_split(CAST({0} AS VARCHAR), '')]),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295)"""

_FIELD = "coalesce(octet_length(encode(CAST({0} AS VARCHAR))) || ':' || CAST({0} AS VARCHAR), '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in FIELDS[:-1]) + " || " + _FIELD + ")"

ORACLE = f"""
WITH RECURSIVE leaf AS (
  SELECT doc_id, coalesce('s' || source, 'n') AS tree, {_LEAF.format('text')} AS leaf,
    CASE WHEN {CRC32.format('doc_id')} % 2 = 0 THEN {_LEAF.format("replace(text, chr(10), '')")} ELSE {_LEAF.format('text')} END AS changed
  FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM leaf),
own AS (
  SELECT tree, 0 AS level, pos, leaf AS digest, n FROM placed
  UNION ALL
  SELECT tree, level + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (n + 2) // 3 FROM own WHERE n > 1 GROUP BY tree, level, pos // 3, n),
subroots AS (
  SELECT tree AS source_tree, row_number() OVER (ORDER BY tree) - 1 AS pos, digest, level AS height, count(*) OVER () AS n FROM own WHERE n = 1),
top AS (
  SELECT 't' AS tree, 0 AS level, pos, digest, n FROM subroots
  UNION ALL
  SELECT tree, level + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (n + 2) // 3 FROM top WHERE n > 1 GROUP BY tree, level, pos // 3, n),
families AS (
  SELECT tree, level, pos // 3 AS family, list(digest ORDER BY pos) AS kids FROM (SELECT * FROM own UNION ALL SELECT * FROM top) WHERE n > 1 GROUP BY ALL),
climb AS (
  SELECT tree AS source_tree, pos AS leaf_pos, tree, 0 AS level, pos, changed AS folded, '' AS proof FROM placed
  UNION ALL
  SELECT source_tree, leaf_pos, tree, level, pos, folded, proof FROM (
    SELECT c.source_tree, c.leaf_pos, f.tree, c.level + 1 AS level, c.pos // 3 AS pos,
      sha256(array_to_string(list_concat(list_slice(f.kids, 1, c.pos % 3), [c.folded], list_slice(f.kids, c.pos % 3 + 2, 3)), '')) AS folded,
      c.proof || array_to_string(list_concat(list_slice(f.kids, 1, c.pos % 3), list_slice(f.kids, c.pos % 3 + 2, 3)), '') AS proof
    FROM climb c JOIN families f ON f.tree = c.tree AND f.level = c.level AND f.family = c.pos // 3
    UNION ALL
    SELECT c.source_tree, c.leaf_pos, 't', 0, s.pos, c.folded, c.proof FROM climb c JOIN subroots s ON s.source_tree = c.tree AND s.height = c.level AND c.tree <> 't'))
SELECT p.doc_id, p.leaf, s.digest AS subroot, r.digest AS root, sha256(c.proof) AS proof_sha256, c.folded AS folded_root, c.folded = r.digest AS verified
FROM placed p JOIN subroots s ON s.source_tree = p.tree
JOIN (SELECT digest, level FROM top WHERE n = 1) r ON true
JOIN climb c ON c.source_tree = p.tree AND c.leaf_pos = p.pos AND c.tree = 't' AND c.level = r.level
"""
