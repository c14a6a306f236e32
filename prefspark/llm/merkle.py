"""A Merkle manifest of a dataset, built by butterfly exchanges.

Rows become leaves (digests of their fields), numbered by id within their group. SPAN consecutive leaves,
a power of the fanout, make a part, which hashes its own subtree. Then parts exchange roots: in round r a
part meets those of its FANOUT neighbouring subtrees of FANOUT ** r parts that have its own place within
the subtree. It learns its siblings' roots, which are its proof of that level, and computes the ancestor,
as every other part below that ancestor does. After the last round each part knows its tree's root and all
of its upper proof: nothing is passed down. At the ragged end of a tree the parts of a smaller subtree take
turns to stand in for the missing ones. The groups' roots are the leaves of a last tree, built by the same
exchange. A round is one shuffle of a row per part, with at most FANOUT rows meeting.

    H         hex sha256 of the inputs' concatenation; digests enter as hex text
    leaf      H of the fields: `-` for null, else the number of UTF-8 bytes, `:` and the value
    node      H of up to FANOUT consecutive nodes; a last run may be shorter, even a single node
    subroot   what remains of a group; its only leaf if there is one
    root      likewise of all subroots, by group (null first, then by bytes)
    proof     per level the run's other nodes, from the leaf to the root

Defined results
* Null fields have a digest of their own; an empty text is not a null. A null group is a group.
* Leaves ascend by id, null first; rows with equal ids by leaf. Equal rows are leaves of their own.
* A group of one leaf, and a dataset of one group, have no level there, so a single row is its own root and
  its proof is the digest of nothing. An empty table has no rows.
* Only the fields, the id and the group are read; other columns do not matter, whatever their names.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefspark.llm.common import drop_written, written
from prefspark.operators.ordinals import numbered
from prefspark.session import new_workdir
from prefspark.sources.tables import drop_table

FANOUT = 8
SPAN = FANOUT**4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PART = "tree string, place long, n long, ids binary, flags binary, leaves binary, claims binary, digest string"
_PATH = "array<struct<place: int, others: array<string>>>"
_HAS_ID, _HAS_CLAIM = 1, 2


def leaf(*values: Column) -> Column:
    """The digest of a row's fields."""
    texts = [v.cast("string") for v in values]
    fields = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*fields), 256)


def digest(nodes: Sequence[str]) -> str:
    return hashlib.sha256("".join(nodes).encode("ascii")).hexdigest()


def levels(leaves: list[str], fanout: int, height: int | None) -> list[list[str]]:
    """The nodes of each level from the leaves up: `height` levels above them, or until one remains."""
    found = [leaves]
    while len(found) <= height if height is not None else len(found[-1]) > 1:
        below = found[-1]
        found.append([digest(below[k : k + fanout]) for k in range(0, len(below), fanout)])
    return found


def _height(place: int, n: int, fanout: int, span: int) -> int | None:
    """Levels within a part. A first part that is not full is all of its tree, and ends where one remains."""
    if place == 0 and n < span:
        return None
    return sum(1 for _ in itertools.takewhile(lambda k: fanout**k < span, itertools.count()))


def _parts(rows: DataFrame, fanout: int, span: int) -> DataFrame:
    """A row per part: its leaves in order, packed, and the root of its subtree; a written table."""

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("seq")
        tree, place = group["tree"].iloc[0], int(group["place"].iloc[0])
        nodes, claims = list(group["leaf"]), [c for c in group["claim"] if c is not None]
        ids = np.array([0 if i is None else int(i) for i in group["id"]], dtype="<i8")
        flags = [(i is not None) * _HAS_ID + (c is not None) * _HAS_CLAIM for i, c in zip(group["id"], group["claim"])]
        top = levels(nodes, fanout, _height(place, len(nodes), fanout, span))[-1]
        row = tree, place, len(nodes), ids.tobytes(), bytes(flags), bytes.fromhex("".join(nodes)), bytes.fromhex("".join(claims)), top[0]
        return pd.DataFrame([row], columns=[c.split()[0] for c in _PART.split(", ")])

    keyed = rows.withColumn("place", F.floor(F.col("seq") / span))
    return written(keyed.groupBy("tree", "place").applyInPandas(pack, _PART), "merkle-parts")


def butterfly(nodes: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """(tree, place, digest) with places 0..n-1 per tree -> a row each with the tree's root as `digest`,
    and `path`: on each level the node's place in its run and the run's other nodes."""
    sizes = nodes.groupBy("tree").agg(F.count(F.lit(1)).alias("size"))
    state = written(
        nodes.select("tree", "place", "digest", F.array().cast(_PATH).alias("path")).join(sizes, "tree"), "merkle-state"
    )
    most, reach = state.agg(F.max("size")).first()[0] or 0, 1
    while reach < most:
        after = written(_exchange(state, fanout, reach), "merkle-state")
        drop_written(state)
        state, reach = after, reach * fanout
    return state.drop("size")


def _exchange(state: DataFrame, fanout: int, reach: int) -> DataFrame:
    """One round: subtrees of `reach` nodes meet their siblings."""
    place, size = F.col("place"), F.col("size")
    subtree = F.floor(place / reach)
    run, within = F.floor(subtree / fanout), place % reach
    # How many nodes this subtree has, and the first of its run, which has the most.
    own_size = F.least(F.lit(reach), size - subtree * reach)
    slots = F.least(F.lit(reach), size - run * fanout * reach)
    sent = (
        state.where(size > reach)
        .select(
            "tree", "size", run.alias("run"), (subtree % fanout).cast("int").alias("digit"), "digest", "place", "path",
            within.alias("within"), F.explode(F.sequence(within, slots - 1, own_size)).alias("slot"),
        )
    )
    own = F.col("slot") == F.col("within")
    member = F.struct("digit", "digest", F.when(own, F.struct("place", "path")).alias("own"))
    met = sent.groupBy("tree", "size", "run", "slot").agg(F.array_sort(F.collect_list(member), _by_digit).alias("members"))
    parent = met.withColumn("parent", F.sha2(F.concat_ws("", F.col("members.digest")), 256))
    each = parent.select("tree", "size", "parent", F.col("members"), F.explode("members").alias("m")).where("m.own is not null")
    others = F.transform(F.filter("members", lambda o: o["digit"] != F.col("m.digit")), lambda o: o["digest"])
    step = F.struct(F.col("m.digit").alias("place"), others.alias("others"))
    climbed = each.select(
        "tree", F.col("m.own.place").alias("place"), F.col("parent").alias("digest"),
        F.concat(F.col("m.own.path"), F.array(step)).cast(_PATH).alias("path"), "size",
    )
    return climbed.unionByName(state.where(size <= reach).select("tree", "place", "digest", "path", "size"))


def _by_digit(a: Column, b: Column) -> Column:
    return a["digit"] - b["digit"]


def build(
    docs: DataFrame, *, claim: Column | None = None, fields: Sequence[str] = FIELDS, id_col="doc_id", group_col="lang",
    fanout: int = FANOUT, span: int = SPAN,
) -> DataFrame:
    """The manifest: a written row per part with its leaves, packed, its `path` upwards, `subroot` and `root`.

    `claim` is a leaf to be checked in place of the row's own where it is not null. `span` is the number of
    leaves of a part, a power of the fanout.
    """
    if span != fanout ** round(np.log(span) / np.log(fanout)):
        raise ValueError(f"a part must hold a power of {fanout} leaves, got {span}")
    group = F.col(group_col).cast("string")
    rows = docs.select(
        F.when(group.isNull(), "0").otherwise(F.concat(F.lit("1"), group)).alias("tree"),
        F.col(id_col).cast("long").alias("id"), leaf(*[F.col(f) for f in fields]).alias("leaf"),
        (F.lit(None).cast("string") if claim is None else claim).alias("claim"),
        F.monotonically_increasing_id().alias("tie"),
    )
    # Sorting samples its input, so the digests are written first. The tie spreads rows that are equal.
    leaves = written(rows, "merkle-leaves")
    order = [F.col("id").asc_nulls_first(), F.col("leaf").asc(), F.col("tie").asc()]
    sorted_leaves = new_workdir(docs.sparkSession, "merkle-order")
    placed = numbered(leaves, order, sorted_leaves, within="tree")
    # Ids travel as text: a column of numbers with nulls would reach pandas as floats.
    parts = _parts(placed.select("tree", "seq", F.col("id").cast("string").alias("id"), "leaf", "claim"), fanout, span)
    drop_written(leaves)
    drop_table(docs.sparkSession, sorted_leaves)
    inner = butterfly(parts.select("tree", "place", "digest"), fanout)
    tops = inner.where("place = 0").select("tree", "digest")
    named = numbered(tops, [F.col("tree").asc()], new_workdir(docs.sparkSession, "merkle-trees"), name="place")
    # Written, so that the one tree they make is a value like others to the joins on it.
    roots = written(named.select(F.lit("").alias("tree"), "place", "digest", F.col("tree").alias("of")), "merkle-subroots")
    outer = butterfly(roots.select("tree", "place", "digest"), fanout)
    whole = roots.select(F.col("of").alias("tree"), "place").join(
        outer.select("place", F.col("digest").alias("root"), F.col("path").alias("above")), "place"
    )
    paths = inner.select("tree", "place", F.col("digest").alias("subroot"), "path").join(whole.drop("place"), "tree")
    told = paths.select("tree", "place", "subroot", "root", F.concat("path", "above").alias("path"))
    return written(parts.drop("digest").join(told, ["tree", "place"]), "merkle-manifest")


def proofs(manifest: DataFrame, *, fanout: int = FANOUT, span: int = SPAN, with_proof=False) -> DataFrame:
    """A row per leaf: id, group, place, leaf, subroot, root, proof_sha256 (H of the proof), folded_root
    (from the claimed leaf, else the leaf, and the proof), and `proof` if asked for."""

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                yield pd.DataFrame(list(_leaves(row, fanout, span, with_proof)), columns=names)

    names = ["id", "tree", "place", "leaf", "subroot", "root", "proof_sha256", "folded_root"] + ["proof"] * with_proof
    schema = ", ".join(f"{n} {'long' if n == 'place' else _PATH if n == 'proof' else 'string'}" for n in names)
    rows = manifest.mapInPandas(unpack, schema)
    group = F.when(F.startswith("tree", F.lit("1")), F.substring("tree", 2, 1 << 30))
    return rows.withColumns({"id": F.col("id").cast("long"), "tree": group}).withColumnRenamed("tree", "group")


def _leaves(row, fanout: int, span: int, with_proof: bool) -> Iterator[tuple]:
    """The rows of one part."""
    raw = row.leaves.hex()
    found = levels([raw[64 * k : 64 * k + 64] for k in range(row.n)], fanout, _height(row.place, row.n, fanout, span))
    inner = found[:-1]
    above = [(int(step["place"]), list(step["others"])) for step in row.path]
    ids, claims, claimed = np.frombuffer(row.ids, dtype="<i8").tolist(), row.claims.hex(), 0
    # Of a node: the others of its run and of all runs above, as one text.
    rest = [["".join(itertools.chain.from_iterable(others for _, others in above))]]
    for nodes in reversed(inner[1:]):
        rest.append([_others(nodes, k, fanout) + rest[-1][k // fanout] for k in range(len(nodes))])
    upper = rest[-1]
    for k in range(row.n):
        own = found[0][k]
        proof = (_others(inner[0], k, fanout) if inner else "") + upper[k // fanout if inner else 0]
        node = own
        if row.flags[k] & _HAS_CLAIM:
            node, claimed = claims[64 * claimed : 64 * claimed + 64], claimed + 1
        at = k
        for nodes in inner:
            low = at - at % fanout
            node = digest([*nodes[low:at], node, *nodes[at + 1 : low + fanout]])
            at //= fanout
        for place, others in above:
            node = digest([*others[:place], node, *others[place:]])
        told = str(ids[k]) if row.flags[k] & _HAS_ID else None, row.tree, row.place * span + k, own, row.subroot, row.root, digest(proof), node
        yield (*told, _proof(inner, above, k, fanout)) if with_proof else told


def _others(nodes: list[str], k: int, fanout: int) -> str:
    low = k - k % fanout
    return "".join(nodes[low:k]) + "".join(nodes[k + 1 : low + fanout])


def _proof(inner: list[list[str]], above: list[tuple[int, list[str]]], k: int, fanout: int) -> list[dict]:
    steps = []
    for nodes in inner:
        low = k - k % fanout
        steps.append({"place": k % fanout, "others": nodes[low:k] + nodes[k + 1 : low + fanout]})
        k //= fanout
    return steps + [{"place": place, "others": others} for place, others in above]


def fold(node: str, proof: Sequence) -> str:
    """The root that a leaf and its proof lead to."""
    for step in proof:
        others, place = list(step["others"]), step["place"]
        node = digest([*others[:place], node, *others[place:]])
    return node
