"""Conversation prefix trie: one SQL ROLLUP over positional turn columns aggregates all prefixes of all conversations together.

A turn is a digest of role and text. A conversation's turns stand in rows of ``COLUMNS`` columns, a row a block; a row's key is the
digest of all turns before the block, which is the node that the prior block ends in. So one ``GROUP BY block, key, ROLLUP(t1..t8)``
gives the nodes of every depth at once, and conversations of any length go on in further blocks, not in further jobs.

Every node has one owner, its least member, and an owner has one node at a depth. What is summed over a subtree is therefore a sum
over the members of the node: of each, what its own nodes from that depth on are worth. A second rollup of these suffix sums gives all
subtree sums, whatever the trie's depth.

Null role or text is empty; turns that tie go by their digests; repeated rows are turns of their own; rows without conv_id belong
to no conversation; a conversation whose turns are all cut off is a member of the root alone; an empty table has no node. Texts are
read once, for digest and length, and are never moved. Further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.llm._frames import alone, discard, saved
from tidegrid.operators.ranking import numbered

#: Positional columns of a block.
COLUMNS = 8
#: Conversation ids that one piece of a list of members spans, so pieces are bounded whatever the group.
SPAN = 256
#: Blocks that one window sums; longer conversations are summed in two steps.
RUN = 512
#: The most turns taken from another conversation, and the distance between those that lend them.
LENT, EVERY = 8, 5

_SLOTS = range(1, COLUMNS + 1)


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, id, bytes): turns numbered from 1 by turn, null first; id is 16 bytes that stand for role and text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    id_ = F.substring(F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)), 1, 16)
    rows = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), id_.alias("id"), F.octet_length(text).cast("long").alias("bytes"))
    return numbered(rows, [F.col("turn").asc_nulls_first(), F.col("id")], "pos", ["conv_id"]).select("conv_id", "pos", "id", "bytes")


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, id, bytes): the first crc32(conv_id) % 9 turns of conversation conv_id - conv_id % 5, then the own ones after as
    many; pos 0 with a null id stands for the conversation itself, which may have no turn left."""
    own = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    own = own.select("conv_id", (F.col("conv_id") - F.col("conv_id") % EVERY).alias("base"), (F.crc32(F.col("conv_id").cast("string")) % (LENT + 1)).alias("h"))
    lent = turns.where((F.col("pos") <= LENT) & (F.col("conv_id") % EVERY == 0)).groupBy(F.col("conv_id").alias("base")).agg(F.array_sort(F.collect_list(F.struct("pos", "id", "bytes"))).alias("lent"))
    heads = own.join(lent, "base", "left").withColumn("lent", F.coalesce(F.slice("lent", F.lit(1), F.col("h").cast("int")), F.array()))
    start = F.array(F.struct(F.lit(0).cast("long").alias("pos"), F.lit(None).cast("binary").alias("id"), F.lit(0).cast("long").alias("bytes")))
    first = heads.select("conv_id", F.inline(F.concat(start, "lent")))
    rest = turns.join(heads.select("conv_id", "h", (F.size("lent") - F.col("h")).alias("move")), "conv_id").where("pos > h").select("conv_id", (F.col("pos") + F.col("move")).alias("pos"), "id", "bytes")
    return first.unionByName(rest)


def _lanes(id_: Column, pos: Column) -> list[Column]:
    """Two hashes of a turn at its position. Exclusive ors of them are the digest of a prefix."""
    return [F.xxhash64(F.lit(1), pos, id_), F.xxhash64(id_, pos, F.lit(2))]


def _running(rows: DataFrame, what: dict[str, tuple[Column, Column]], forward: bool) -> DataFrame:
    """rows (conv_id, block, ...) with, for each name, an aggregate over all earlier (or later) blocks of the conversation. what: by
    name the aggregate of a column's values, and the way two of its values are joined; runs of blocks first, so no window is longer
    than RUN rows or the number of runs."""
    run = F.floor(F.col("block") / RUN)
    order = F.col("block") if forward else -F.col("block")
    within = Window.partitionBy("conv_id", "_run").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    over = Window.partitionBy("conv_id").orderBy(F.col("_run") if forward else -F.col("_run")).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_run", run).withColumns({f"_in_{k}": F.coalesce(agg.over(within), F.lit(0)) for k, (agg, _) in what.items()})
    runs = rows.groupBy("conv_id", "_run").agg(*(agg.alias(f"_all_{k}") for k, (agg, _) in what.items()), F.count("*").alias("_n"))
    # a conversation of one run has nothing before it, so most need no second step
    runs = runs.select("conv_id", "_run", *(F.coalesce((F.bit_xor if k.startswith("key") else F.sum)(f"_all_{k}").over(over), F.lit(0)).alias(f"_out_{k}") for k in what))
    long = runs.where(" OR ".join(f"_out_{k} != 0" for k in what))
    joined = rows.join(long, ["conv_id", "_run"], "left")
    return joined.withColumns({k: join(F.col(f"_in_{k}"), F.coalesce(F.col(f"_out_{k}"), F.lit(0))) for k, (_, join) in what.items()} if what else {}).drop("_run", *(f"{p}_{k}" for k in what for p in ("_in", "_out")))


def _xor(a: Column, b: Column) -> Column:
    return a.bitwiseXOR(b)


def blocks(turns: DataFrame) -> DataFrame:
    """(conv_id, block, key1, key2, t1.., b1.., n): a row a block; key1 and key2 are the digest of all turns before it, n its turns.
    Every conversation has a block 0."""
    block = F.when(F.col("pos") == 0, F.lit(0)).otherwise(F.floor((F.col("pos") - 1) / COLUMNS)).cast("long")
    slot = F.when(F.col("pos") == 0, F.lit(0)).otherwise((F.col("pos") - 1) % COLUMNS + 1)
    lanes = [F.when(F.col("pos") == 0, F.lit(0).cast("long")).otherwise(x) for x in _lanes(F.col("id"), F.col("pos"))]
    rows = turns.select("conv_id", block.alias("block"), slot.alias("slot"), "id", "bytes", *(x.alias(f"l{k}") for k, x in enumerate(lanes, 1)))
    wide = rows.groupBy("conv_id", "block").agg(
        *(F.max(F.when(F.col("slot") == j, F.col("id"))).alias(f"t{j}") for j in _SLOTS),
        *(F.max(F.when(F.col("slot") == j, F.col("bytes"))).alias(f"b{j}") for j in _SLOTS),
        *(F.bit_xor(f"l{k}").alias(f"own{k}") for k in (1, 2)),
        F.sum((F.col("slot") > 0).cast("int")).alias("n"),
    )
    return _running(wide, {f"key{k}": (F.bit_xor(f"own{k}"), _xor) for k in (1, 2)}, True)


def _rolled(rows: DataFrame, measures: str) -> DataFrame:
    """One ROLLUP over the blocks of all conversations: a row a node below the root, with depth, the node's key and its parent's, and the
    measures; in them {j} stands for each slot, and the value of the node's own slot is kept."""
    slots = ", ".join(f"t{j}" for j in _SLOTS)
    depth = f"{COLUMNS} - bit_count(grouping_id())"
    out = rows.sparkSession.sql(f"SELECT block, key1, key2, {slots}, CAST({depth} AS INT) AS slot, {measures} FROM {{rows}} GROUP BY block, key1, key2, ROLLUP ({slots}) HAVING slot > 0", rows=rows)
    out = out.where(F.coalesce(*(F.when(F.col("slot") == j, F.col(f"t{j}").isNotNull()) for j in _SLOTS)))  # else the conversation ended before
    base = F.col("block") * COLUMNS
    xor = lambda key, n, lanes: F.aggregate(F.slice(lanes, F.lit(1), n), F.col(key), lambda a, h: a.bitwiseXOR(h))
    for k in (1, 2):
        hashes = F.array(*(_lanes(F.col(f"t{j}"), base + j)[k - 1] for j in _SLOTS))
        out = out.withColumns({f"node{k}": xor(f"key{k}", F.col("slot"), hashes), f"parent{k}": xor(f"key{k}", F.col("slot") - 1, hashes)})
    return out.withColumn("depth", base + F.col("slot"))


def _ends(keys: DataFrame) -> DataFrame:
    """(key1, key2, ends_sha256) of (conv_id, key1, key2): the digest of each key's ids in numeric order. Ids are joined in pieces of SPAN
    ids; the pieces of a key stream through one hash in their order and are never held together."""
    pieces = keys.groupBy("key1", "key2", F.floor(F.col("conv_id") / SPAN).alias("piece")).agg(F.concat_ws(",", F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string"))).alias("ids"))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, h = None, hashlib.sha256()
        for batch in batches:
            out = []
            for a, b, ids in zip(batch.column("key1").to_pylist(), batch.column("key2").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if (a, b) != now:
                    if now is not None:
                        out.append((*now, h.hexdigest()))
                    now, h = (a, b), hashlib.sha256(ids.encode())
                else:
                    h.update(f",{ids}".encode())
            yield pa.RecordBatch.from_pylist([dict(zip(("key1", "key2", "ends_sha256"), r, strict=True)) for r in out], pa.schema([("key1", pa.int64()), ("key2", pa.int64()), ("ends_sha256", pa.string())]))
        if now is not None:
            yield pa.RecordBatch.from_pylist([{"key1": now[0], "key2": now[1], "ends_sha256": h.hexdigest()}], pa.schema([("key1", pa.int64()), ("key2", pa.int64()), ("ends_sha256", pa.string())]))

    return pieces.repartition("key1", "key2").sortWithinPartitions("key1", "key2", "piece").mapInArrow(digests, "key1 long, key2 long, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """A row a node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns = alone(conversations.sparkSession, "turns", lambda: ordered_turns(conversations))
    rows = saved(blocks(rebuilt(turns)), "trie-blocks")
    discard(turns)
    at_slot = lambda c: f"element_at(array({', '.join(f'{c}{j}' for j in _SLOTS)}), CAST({COLUMNS} - bit_count(grouping_id()) AS INT))"

    # first rollup: who owns a node, what it is worth by itself, and whether no member goes on
    last = rows.withColumns({f"e{j}": (F.col("n") == j).cast("long") for j in _SLOTS})
    nxt = rows.where((F.col("block") > 0) & (F.col("n") > 0)).select("conv_id", (F.col("block") - 1).alias("block"), F.lit(0).alias("_more"))
    last = last.join(nxt, ["conv_id", "block"], "left").withColumn(f"e{COLUMNS}", F.col(f"e{COLUMNS}") * F.coalesce("_more", F.lit(1)))  # a full block may go on
    nodes = _rolled(last, ", ".join(["min(conv_id) AS conv_id", "count(*) AS n_convs", *(f"sum(e{j}) AS e{j}, max(b{j}) AS b{j}" for j in _SLOTS)]))
    pick = lambda c: F.element_at(F.array(*(f"{c}{j}" for j in _SLOTS)), F.col("slot"))
    nodes = nodes.select("conv_id", "block", "slot", "depth", "n_convs", ((F.col("n_convs") - 1) * pick("b")).alias("worth"), (pick("e") == F.col("n_convs")).cast("long").alias("leaf"), "node1", "node2", "parent1", "parent2")
    nodes = saved(nodes, "trie-nodes")

    # what each conversation's own nodes from a slot on are worth
    own = nodes.groupBy("conv_id", "block").agg(*(F.sum(F.when(F.col("slot") == j, F.col(c))).alias(f"{c}{j}") for c in ("worth", "leaf") for j in _SLOTS), *(F.count(F.when(F.col("slot") == j, 1)).alias(f"o{j}") for j in _SLOTS))
    own = rows.join(own, ["conv_id", "block"], "left").na.fill(0, [f"{c}{j}" for c in ("worth", "leaf", "o") for j in _SLOTS])
    total = lambda c: sum((F.col(f"{c}{j}") for j in _SLOTS[1:]), F.col(f"{c}1"))
    own = own.withColumns({"own_worth": total("worth"), "own_leaf": total("leaf")})
    own = _running(own, {c: (F.sum(f"own_{c}"), lambda a, b: a + b) for c in ("worth", "leaf")}, False)
    lead = own.where("block > 0 AND o1 > 0").select("conv_id", (F.col("block") - 1).alias("block"), F.lit(1).cast("long").alias("_next"))
    own = own.join(lead, ["conv_id", "block"], "left")
    for c in ("worth", "leaf"):
        after = F.col(c)
        for j in reversed(_SLOTS):
            after = after + F.col(f"{c}{j}")
            own = own.withColumn(f"s_{c}{j}", after)
    own = own.withColumns({f"k{j}": F.col(f"o{j + 1}") if j < COLUMNS else F.coalesce("_next", F.lit(0)) for j in _SLOTS})
    own = saved(own.select("conv_id", "block", "key1", "key2", "o1", *(f"t{j}" for j in _SLOTS), *(f"{c}{j}" for c in ("s_worth", "s_leaf", "k") for j in _SLOTS)), "trie-sums")

    # second rollup: sums over members are sums over subtrees
    summed = _rolled(own, ", ".join(f"sum({at_slot(c)}) AS {name}" for c, name in (("s_leaf", "n_leaves"), ("s_worth", "saved_tokens"), ("k", "n_children"))) + ", min(conv_id) AS conv_id")
    summed = summed.select("conv_id", "depth", "n_leaves", "saved_tokens", "n_children")
    first = own.where("block = 0")
    top = first.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.sum("o1").alias("n_children"), F.sum("s_leaf1").alias("n_leaves"), F.sum("s_worth1").alias("saved_tokens")).where("n_convs > 0")
    top = top.withColumn("n_leaves", F.when(F.col("n_children") == 0, F.lit(1)).otherwise(F.col("n_leaves")))  # the root alone
    top = top.withColumns({"depth": F.lit(0).cast("long"), "parent_conv_id": F.lit(None).cast("long"), "node1": F.lit(0).cast("long"), "node2": F.lit(0).cast("long")})

    # an owner's nodes hang below each other; only its first hangs below another owner's
    starts = nodes.groupBy("conv_id").agg(F.min("depth").alias("depth"))
    tops = nodes.join(starts, ["conv_id", "depth"]).select(F.col("conv_id").alias("_conv"), "depth", "parent1", "parent2")
    hung = tops.where("depth > 1").join(nodes.select("node1", "node2", F.col("conv_id").alias("_parent")), (F.col("parent1") == F.col("node1")) & (F.col("parent2") == F.col("node2"))).select("_conv", F.col("depth").alias("_depth"), "_parent")
    root = first.agg(F.min("conv_id").alias("_root"))
    full = nodes.join(summed, ["conv_id", "depth"]).join(hung, (F.col("conv_id") == F.col("_conv")) & (F.col("depth") == F.col("_depth")), "left").crossJoin(F.broadcast(root))
    full = full.withColumn("parent_conv_id", F.when(F.col("depth") == 1, F.col("_root")).otherwise(F.coalesce("_parent", "conv_id")))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "node1", "node2"]
    full = full.select(*columns).unionByName(top.select(*columns))
    ended = _running_keys(rows)
    out = full.join(_ends(ended).withColumnsRenamed({"key1": "_k1", "key2": "_k2"}), (F.col("node1") == F.col("_k1")) & (F.col("node2") == F.col("_k2")), "left")
    empty = hashlib.sha256(b"").hexdigest()
    return out.select(*(F.col(c).cast("long").alias(c) for c in columns[:-2]), F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"))


def _running_keys(rows: DataFrame) -> DataFrame:
    """(conv_id, key1, key2): each conversation's digest of all its turns."""
    last = rows.groupBy("conv_id").agg(F.max_by(F.struct("key1", "key2", "own1", "own2"), "block").alias("k"))
    return last.select("conv_id", *(F.col(f"k.key{k}").bitwiseXOR(F.col(f"k.own{k}")).alias(f"key{k}") for k in (1, 2)))
