"""The prefix trie of conversations: a node for each distinct sequence of first turns, with
totals of its subtree found by parallel tree contraction."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import arrow_schema, small_batches
from tagloom.operators.joins import sized_join
from tagloom.operators.ordering import running_totals
from tagloom.session import materialise, small_side

ROOT = "0:0"

# The query's conversations: in blocks of so many ids, each starts with up to ``HEADS - 1`` turns
# of the first of its block.
BLOCK = 100
HEADS = 6

# Ids (as a power of two) of one piece of the list of the conversations that end in a node.
PIECE_BITS = 12


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, digest, chars) of ``conversations`` (conv_id, turn, role, text): the turns of
    each conversation numbered from 1 in the order of ``turn``, null first, those of the same number in
    the order of the digest. ``digest`` stands for role and text, of which null is empty;
    ``chars`` are the code points of the text. Rows without a conv_id are in no conversation.

    Texts are not shuffled, and a conversation of any length is numbered by many tasks.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        digest.alias("digest"),
        F.length(text).cast("long").alias("chars"),
        F.lit(1).cast("long").alias("one"),
    )
    turns = materialise(turns, "turns")
    order = [F.col("turn").asc_nulls_first(), F.col("digest")]
    placed = running_totals(turns, "conv_id", order, ["one"])
    return materialise(placed.select("conv_id", F.col("run_one").alias("pos"), "digest", "chars"), "turns")


def members_of(turns: DataFrame) -> DataFrame:
    """(conv_id, length) of the conversations of ``turns``."""
    return turns.groupBy("conv_id").agg(F.count("*").alias("length"))


def with_heads(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``turns`` and members of the conversations of ``turns`` with other heads: the first h turns
    of conversation ``c`` come from the first one of its block (``BLOCK`` ids), h being the
    CRC-32 of the id modulo ``HEADS``. A block whose first one is short or absent has shorter
    heads, so a conversation may be left without a turn; it stays a member.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    base = F.col("conv_id") - F.col("conv_id") % BLOCK
    lengths = members_of(turns).select("conv_id", h.alias("h"), base.alias("base"), "length")
    lengths = materialise(lengths, "lengths")
    first = lengths.filter("conv_id = base").select("base", F.col("length").alias("there"))
    members = lengths.join(first, "base", "left").withColumn("head", F.least("h", F.coalesce("there", F.lit(0))))
    members = materialise(
        members.select(
            "conv_id", "base", "h", "head", (F.col("head") + F.greatest(F.col("length") - F.col("h"), F.lit(0))).alias("length")
        ),
        "members",
    )
    heads = turns.filter((F.col("conv_id") % BLOCK == 0) & (F.col("pos") < HEADS))
    heads = heads.withColumnRenamed("conv_id", "base").join(members.filter("head > 0"), "base")
    heads = heads.filter("pos <= head").select("conv_id", "pos", "digest", "chars")
    rest = sized_join(turns.filter(F.col("pos") > h), members.select("conv_id", "h", "head"), "conv_id", "digest")
    rest = rest.select("conv_id", (F.col("pos") - F.col("h") + F.col("head")).alias("pos"), "digest", "chars")
    return heads.unionByName(rest), members.select("conv_id", "length")


def prefixes(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, pos, digest, chars) with ``node``, a key of the first ``pos`` turns, and
    ``parent``, that of those before it.

    Each turn stands for two 64-bit hashes of its place and digest. A key holds both
    sums, exact, over the turns of a prefix, so it takes no order and no array of turns.
    """
    for i in (1, 2):
        hashed = F.xxhash64(F.lit(i), F.col("pos"), F.col("digest")).cast("decimal(20,0)")
        turns = turns.withColumn(f"e{i}", hashed)
    turns = materialise(turns.drop("digest"), "elements")
    summed = running_totals(turns, "conv_id", [F.col("pos")], ["e1", "e2"])
    key = lambda a, b: F.concat_ws(":", a.cast("string"), b.cast("string"))
    ends, own = (F.col("run_e1"), F.col("run_e2")), (F.col("e1"), F.col("e2"))
    return summed.select(
        "conv_id", "pos", "chars", key(*ends).alias("node"), key(*[r - e for r, e in zip(ends, own)]).alias("parent")
    )


def subtree_totals(tree: DataFrame, sums: Sequence[str]) -> DataFrame:
    """(id, *sums): for every node of ``tree`` (id, parent, n_children, *sums) the sums of the columns over
    its subtree, itself included. Roots have no parent; there may be several trees.

    Parallel tree contraction. Each round rakes all leaves, whose sums go to their parents,
    and compresses unary chains: where a node and its only child both have one child left, and a
    coin tossed by id and round says so, the child is spliced out, its sums go to the node, and
    its own child moves up. That takes a number of rounds in the order of the logarithm of the nodes,
    also for one long chain. A leaf's sums are complete when it is raked. A spliced node's are
    what it had then plus the total of the child it was parted from, so the rounds are undone last to
    first; each reads only the nodes that were left after it, so all of them together read the
    tree a few times. Children of one node are summed up before they are shuffled.
    """
    nodes = tree.select("id", "parent", F.col("n_children").alias("n"), *sums)
    raked: list[DataFrame] = []
    parted: list[DataFrame | None] = []
    while True:
        leaf = F.col("n") == 0
        raked.append(nodes.filter(leaf).select("id", *sums))
        kids = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(
            *[F.coalesce(F.sum(F.when(leaf, F.col(c))), F.lit(0)).alias(f"_{c}") for c in sums],
            F.count_if(leaf).alias("_leaves"),
            F.max(F.when(~leaf, F.col("id"))).alias("child"),
        )
        left = nodes.filter("n > 0").join(kids, "id").withColumn("n", F.col("n") - F.col("_leaves"))
        left = materialise(
            left.select("id", "parent", "n", "child", *[(F.col(c) + F.col(f"_{c}")).alias(c) for c in sums]), "left"
        )
        if left.isEmpty():
            break
        tossed = F.xxhash64(F.lit(len(raked)), F.col("id")) % 2 == 0
        unary = left.filter("n = 1")
        stay = unary.filter(tossed).select(F.col("id").alias("above"), F.col("child").alias("id"))
        out = unary.filter(~tossed).select("id", F.col("child").alias("below"), *sums)
        spliced = materialise(out.join(stay, "id"), "spliced")
        if spliced.isEmpty():
            parted.append(None)
            nodes = left.drop("child")
            continue
        parted.append(spliced)
        none, zero = F.lit(None).cast("long"), F.lit(0).cast("long")
        change = lambda i, up, gone, own: F.struct(
            i.alias("id"), up.alias("_up"), F.lit(gone).alias("_gone"),
            *[(F.col(c) if own else zero).alias(f"_{c}") for c in sums],
        )
        changes = spliced.select(F.inline(F.array(
            change(F.col("above"), none, 0, True),
            change(F.col("below"), F.col("above"), 0, False),
            change(F.col("id"), none, 1, False),
        )))
        changes = changes.groupBy("id").agg(
            F.max("_up").alias("_up"), F.max("_gone").alias("_gone"), *[F.sum(f"_{c}").alias(f"_{c}") for c in sums]
        )
        moved = left.join(changes, "id", "left").filter("_gone IS NULL OR _gone = 0")
        nodes = materialise(
            moved.select(
                "id",
                F.coalesce("_up", "parent").alias("parent"),
                "n",
                *[(F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in sums],
            ),
            "nodes",
        )
    known = raked.pop()
    for ended, spliced in zip(reversed(raked), reversed(parted)):
        if spliced is not None:
            below = known.select(F.col("id").alias("below"), *[F.col(c).alias(f"_{c}") for c in sums])
            totals = below.join(small_side(spliced), "below")
            totals = totals.select("id", *[(F.col(c) + F.col(f"_{c}")).alias(c) for c in sums])
            known = known.unionByName(materialise(totals, "totals"))
        known = known.unionByName(ended)
    return known


def end_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) of ``ends`` (node, conv_id): the SHA-256 of the ids in order, with commas.

    Ids are first put in order in pieces of ``2 ** PIECE_BITS`` possible ids, by many tasks. A
    node's pieces, texts of some 80 KB at most, then pass through one task, as the digest
    takes them one after the other; it holds one batch of them at a time.
    """
    small_batches(ends.sparkSession)
    ids = F.array_sort(F.collect_list("conv_id")).cast("array<string>")
    pieces = ends.groupBy("node", F.shiftright("conv_id", PIECE_BITS).alias("part")).agg(
        F.array_join(ids, ",").alias("ids")
    )
    schema = "node string, ends_sha256 string"

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, hashlib.sha256()
        for batch in batches:
            out = []
            for key, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key == node:
                    state.update(b",")
                else:
                    if node is not None:
                        out.append((node, state.hexdigest()))
                    node, state = key, hashlib.sha256()
                state.update(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], schema=arrow_schema(schema))
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([state.hexdigest()])], schema=arrow_schema(schema))

    ordered = pieces.repartition("node").sortWithinPartitions("node", "part").select("node", "ids")
    return ordered.mapInArrow(digest, schema)


def prefix_trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """The nodes of the trie of ``turns`` (conv_id, pos, digest, chars; ``pos`` from 1 without a gap), in
    which each of ``members`` (conv_id, length) starts at the root, whether it has turns or not:

    ``conv_id`` the smallest member that starts with the node's turns, ``depth`` their number,
    ``parent_conv_id`` the parent's conv_id (null for the root), ``n_convs`` members,
    ``n_children``, ``n_leaves`` childless nodes of its subtree, ``saved_tokens`` the sum over its subtree of
    members but one times code points of the last text, ``ends_sha256`` of :func:`end_digests` for
    the members that end there. Without members there is no node. Of (conv_id, depth) there is one node.
    """
    placed = materialise(prefixes(turns), "prefixes")
    nodes = placed.groupBy("node", "parent", F.col("pos").alias("depth")).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("chars").alias("chars")
    )
    zero = F.lit(0).cast("long")
    root = members.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    root = root.select(
        F.lit(ROOT).alias("node"), F.lit(None).cast("string").alias("parent"), zero.alias("depth"),
        "conv_id", "n_convs", zero.alias("chars"),
    )
    nodes = nodes.unionByName(root).withColumn("id", F.monotonically_increasing_id())
    nodes = materialise(nodes, "nodes")
    above = nodes.select(F.col("node").alias("parent"), F.col("id").alias("pid"), F.col("conv_id").alias("parent_conv_id"))
    linked = sized_join(nodes.filter("parent IS NOT NULL").select("id", "parent"), above, "parent", "id")
    linked = materialise(linked.select("id", "pid", "parent_conv_id"), "parents")
    children = linked.groupBy(F.col("pid").alias("id")).agg(F.count("*").alias("n_children"))
    tree = nodes.drop("parent").join(linked, "id", "left").join(children, "id", "left")
    tree = materialise(tree.withColumn("n_children", F.coalesce("n_children", zero)), "tree")
    totals = subtree_totals(
        tree.select(
            "id", F.col("pid").alias("parent"), "n_children",
            (F.col("n_children") == 0).cast("long").alias("n_leaves"),
            ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
        ),
        ["n_leaves", "saved_tokens"],
    )
    last = placed.withColumnRenamed("pos", "length").join(members.filter("length > 0"), ["conv_id", "length"])
    ends = last.select("node", "conv_id").unionByName(
        members.filter("length = 0").select(F.lit(ROOT).alias("node"), "conv_id")
    )
    none = F.lit(hashlib.sha256(b"").hexdigest())
    whole = tree.join(totals, "id").join(end_digests(ends), "node", "left")
    return whole.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", none).alias("ends_sha256"),
    )
