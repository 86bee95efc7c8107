"""A Merkle manifest of a dataset, and proofs of its rows by an octopus multiproof.

Every row is a leaf, the SHA-256 of its columns. The leaves of a language, in order of
``doc_id``, are folded eight at a time into one subroot; the subroots, in order of the
language, are folded likewise into the root. A row's proof is the siblings on its way up.

Leaves are numbered by two passes over ranges. A task folds ``LEVELS`` levels of a slice of
``ARITY ** LEVELS`` nodes, so a tree of n leaves takes log n / ``LEVELS`` rounds, each over
what the one before has left.

Proofs are made per slice of leaves. The slice's rows are the arms of one octopus: it
computes the coordinates of all nodes that its rows need and that cannot be derived from
the rows themselves, each once; the nodes are fetched by one join; the slice derives the
interiors its rows share and writes each row's proof from them. Any subset of the rows can
be proved, by the same steps.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from llm.shared import ranked, stage

ARITY = 8
LEVELS = 3
SLICE = ARITY**LEVELS

NODE = "tree string, level int, pos long, width long, digest string"
COORDINATE = "tree string, slice long, top boolean, level int, pos long"
PROVED = (
    "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, "
    "pos long, siblings string"
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Manifest:
    """``leaves (doc_id, tree, leaf, now, pos, width, place)``, ``nodes`` of all trees, ``top`` of the tree over them.

    ``tree`` is the language behind an ``s``, or nothing for null. ``now`` is the digest of the
    row as it is found when proved. ``trees`` is the number of trees, ``root`` the root.
    """

    leaves: DataFrame
    nodes: DataFrame
    top: DataFrame
    trees: int
    root: str | None

    def write(self, path: str) -> None:
        """Write the manifest to a folder, root and all."""
        for name in ("leaves", "nodes", "top"):
            getattr(self, name).write.parquet(f"{path}/{name}")
        self.leaves.sparkSession.createDataFrame([(self.trees, self.root)], "trees long, root string").coalesce(1).write.parquet(f"{path}/root")

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> Manifest:
        row = spark.read.parquet(f"{path}/root").first()
        return cls(*(spark.read.parquet(f"{path}/{x}") for x in ("leaves", "nodes", "top")), row["trees"], row["root"])


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(text: Column) -> Column:
    """The digest of a row of ``documents`` with ``text`` as its text."""
    columns = *(F.col(c) for c in ("doc_id", "source", "lang", "n_chars")), text
    written = [c.cast("string") for c in columns]
    parts = [F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c)) for c in written]
    return F.sha2(F.concat(*parts), 256)


def folded(leaves: DataFrame) -> DataFrame:
    """All nodes above ``leaves (tree, pos, width, digest)``; ``width`` counts the nodes of a tree's level."""

    def fold(level: int):
        def run(table: pa.Table) -> pa.Table:
            table = table.sort_by("pos")
            tree, width = table.column("tree")[0].as_py(), table.column("width")[0].as_py()
            first, digests, rows = table.column("pos")[0].as_py(), table.column("digest").to_pylist(), []
            for up in range(level + 1, level + LEVELS + 1):
                if width <= 1:
                    break
                first, width = first // ARITY, -(-width // ARITY)
                digests = [_sha("".join(digests[k : k + ARITY])) for k in range(0, len(digests), ARITY)]
                rows += [(tree, up, first + k, width, x) for k, x in enumerate(digests)]
            return _table(rows, NODE)

        return run

    level, out, rest = 0, [], leaves.select("tree", "pos", "width", "digest").where("width > 1")
    while True:
        sliced = rest.withColumn("slice", F.floor(F.col("pos") / SLICE))
        new = stage(sliced.groupBy("tree", "slice").applyInArrow(fold(level), NODE), "nodes")
        out.append(new)
        level += LEVELS
        rest = new.where((F.col("level") == level) & (F.col("width") > 1)).select("tree", "pos", "width", "digest")
        if not rest.head(1):
            break
    nodes = out[0]
    for more in out[1:]:
        nodes = nodes.union(more)
    return nodes


def manifest(docs: DataFrame, now: Column | None = None) -> Manifest:
    """The manifest of ``docs``.

    ``docs`` needs the columns of ``documents``; other columns are ignored. Nulls are ``-``, in any
    column. Rows of one ``doc_id`` are ordered by their digests, those without one come first;
    repeated rows are leaves of their own. ``now`` is the text as found when proofs are made, where
    it may differ.
    """
    tree = F.coalesce(F.concat(F.lit("s"), F.col("lang")), F.lit(""))
    own = leaf(F.col("text"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), tree.alias("tree"), own.alias("leaf"), (own if now is None else leaf(now)).alias("now"))
    # Leaves that differ in `now` alone repeat as leaves; their order is fixed by it.
    placed = ranked(stage(rows, "leaves"), ["tree", "doc_id", "leaf", "now"], "pos", ["tree"])
    placed = stage(placed, "placed")
    trees = stage(placed.groupBy("tree").agg(F.count(F.lit(1)).alias("width")), "trees")
    count = trees.count()
    trees = stage(ranked(trees, ["tree"], "place"), "trees")
    leaves = stage(placed.join(trees, "tree"), "leaves")
    nodes = folded(leaves.select("tree", "pos", "width", F.col("leaf").alias("digest")))
    # A lone leaf is its tree's subroot.
    subroots = nodes.where("width = 1").select("tree", "digest").union(leaves.where("width = 1").select("tree", F.col("leaf").alias("digest")))
    roots = subroots.join(trees.select("tree", "place"), "tree").select(F.lit("").alias("tree"), F.col("place").alias("pos"), F.lit(count).cast("long").alias("width"), "digest")
    base = stage(roots.select("tree", F.lit(0).alias("level"), "pos", "width", "digest"), "subroots")
    top = base.union(folded(base))
    row = top.where("width = 1").select("digest").first()
    return Manifest(leaves, nodes, top, count, row["digest"] if row else None)


def missing(positions: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """Level by level, the nodes that a proof of all leaves at ``positions`` needs and they do not give."""
    known = np.unique(positions)
    while width > 1:
        runs = np.unique(known // ARITY)
        all_ = (runs[:, None] * ARITY + np.arange(ARITY)).ravel()
        yield np.setdiff1d(all_[all_ < width], known, assume_unique=True)
        known, width = runs, -(-width // ARITY)


class Octopus:
    """The nodes of one tree above some leaves, each derived once, and every leaf's way through them."""

    def __init__(self, leaves: dict[int, str], width: int, fetched: dict[tuple[int, int], str]) -> None:
        self.runs: list[dict[int, list[str]]] = []
        known = leaves
        while width > 1:
            runs: dict[int, list[str]] = {}
            for run in {pos // ARITY for pos in known}:
                ends = range(run * ARITY, min(run * ARITY + ARITY, width))
                runs[run] = [known[p] if p in known else fetched[len(self.runs), p] for p in ends]
            self.runs.append(runs)
            known, width = {run: _sha("".join(kids)) for run, kids in runs.items()}, -(-width // ARITY)
        self.root = next(iter(known.values()))
        self.sides: dict[tuple[int, int], tuple[str, str]] = {}

    def way(self, pos: int) -> list[tuple[str, str]]:
        """Level by level, the siblings before and behind the node on the way up from ``pos``."""
        out = []
        for level, runs in enumerate(self.runs):
            at = level, pos
            if at not in self.sides:
                kids, k = runs[pos // ARITY], pos % ARITY
                self.sides[at] = "".join(kids[:k]), "".join(kids[k + 1 :])
            out.append(self.sides[at])
            pos //= ARITY
        return out


def climbed(digest: str, way: list[tuple[str, str]]) -> str:
    """The root that ``digest`` gives with the siblings on its way."""
    for before, behind in way:
        digest = _sha(before + digest + behind)
    return digest


def _needs(trees: int):
    def run(table: pa.Table) -> pa.Table:
        tree, slice_ = table.column("tree")[0].as_py(), table.column("slice")[0].as_py()
        place, width = table.column("place")[0].as_py(), table.column("width")[0].as_py()
        rows = []
        for top, positions, n in ((False, table.column("pos").to_numpy(), width), (True, np.array([place]), trees)):
            for level, absent in enumerate(missing(positions, n)):
                rows += [(tree, slice_, top, level, p) for p in absent.tolist()]
        return _table(rows, COORDINATE)

    return run


def _expand(trees: int, root: str | None):
    def run(leaves: pa.Table, fetched: pa.Table) -> pa.Table:
        rows = []
        if len(leaves):
            place, width = leaves.column("place")[0].as_py(), leaves.column("width")[0].as_py()
            got: dict[bool, dict[tuple[int, int], str]] = {False: {}, True: {}}
            for top, level, pos, digest in zip(*(fetched.column(c).to_pylist() for c in ("top", "level", "pos", "digest")), strict=True):
                got[top][level, pos] = digest
            ids, digests, found, positions = (leaves.column(c).to_pylist() for c in ("doc_id", "leaf", "now", "pos"))
            own = Octopus(dict(zip(positions, digests, strict=True)), width, got[False])
            over = Octopus({place: own.root}, trees, got[True]).way(place)
            for doc_id, digest, now, pos in zip(ids, digests, found, positions, strict=True):
                way = own.way(pos) + over
                siblings = "".join(before + behind for before, behind in way)
                up = climbed(now, way)
                rows.append((doc_id, digest, own.root, root, _sha(siblings), up, up == root, pos, siblings))
        return _table(rows, PROVED)

    return run


def proofs(book: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """Proofs of the rows of ``book.leaves``, or of ``wanted``, some of them.

    ``siblings`` is the proof: the digests beside the way, level by level, left to right.
    ``folded_root`` follows from ``now`` and the siblings; ``verified`` says whether it is the root.
    """
    rows = (book.leaves if wanted is None else wanted).withColumn("slice", F.floor(F.col("pos") / SLICE))
    by = ("tree", "slice")
    needs = stage(rows.select(*by, "pos", "width", "place").groupBy(*by).applyInArrow(_needs(book.trees), COORDINATE), "needs")
    at = ["tree", "level", "pos"]
    inner = needs.where("NOT top")
    fetched = book.nodes.select(*at, "digest").join(inner, at)
    if inner.where("level = 0").head(1):  # rows whose neighbours are not wanted themselves
        base = book.leaves.select("tree", F.lit(0).alias("level"), "pos", F.col("leaf").alias("digest"))
        fetched = fetched.union(base.join(inner.where("level = 0"), at))
    above = book.top.select("level", "pos", "digest").join(needs.where("top"), ["level", "pos"])
    columns = (*by, "top", "level", "pos", "digest")
    fetched = stage(fetched.select(*columns).union(above.select(*columns)), "fetched")
    leaves = rows.select(*by, "doc_id", "leaf", "now", "pos", "width", "place")
    return leaves.groupBy(*by).cogroup(fetched.groupBy(*by)).applyInArrow(_expand(book.trees, book.root), PROVED)


def tampered() -> Column:
    """``text`` with A-Z lower-cased where 3 divides the checksum of the decimal ``doc_id``; elsewhere as it is."""
    chosen = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return F.when(F.coalesce(chosen, F.lit(False)), F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))


def proof_digest(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` its leaf, proof and the root that follows from it once some rows were tampered with."""
    return proofs(manifest(docs, tampered())).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def _table(rows: list[tuple], schema: str) -> pa.Table:
    types = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.table({name: pa.array(c, types[kind]) for (name, kind), c in zip(fields, columns, strict=True)})
