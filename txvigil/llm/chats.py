"""Chat formatting as a prefix tree.

Conversations that begin with the same turns share them. A node of the tree is a turn after
all the turns before it; the nodes are laid out depth first, each once, with the position
its first token has in its conversations and the stretches of the stream that its tokens may
attend to besides the node itself: those of its ancestors. A token is a code point.

A turn is written ``### role: text</turn>`` and a line break. Backslash, ``#``, ``<`` and (in
roles) ``:`` are written with a backslash before them, so neither mark occurs inside.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import md5, sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from txvigil.llm.common import stored

LOSS_ROLE = "assistant"
_HEAD, _TAIL = "### ", "</turn>\n"
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*): ((?:[^\\#<]|\\.)*)</turn>\n", re.S)
_ID = 16


def escaped(text: str, also: str = "") -> str:
    return re.sub(rf"[\\#<{also}]", r"\\\g<0>", text)


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def formatted(role: str, text: str) -> tuple[str, int, int]:
    """The turn as written, and where its text lies in it (start, end)."""
    head = f"{_HEAD}{escaped(role, ':')}: "
    body = escaped(text)
    return head + body + _TAIL, len(head), len(head) + len(body)


def parsed(written: str) -> list[tuple[str, str]]:
    """(role, text) of every turn; the inverse of ``formatted``."""
    turns, at = [], 0
    while at < len(written):
        found = _TURN.match(written, at)
        if not found:
            raise ValueError(f"no turn at {at}")
        turns.append((unescaped(found[1]), unescaped(found[2])))
        at = found.end()
    return turns


def running(rows: DataFrame, order: list[str], value: str, total: str) -> DataFrame:
    """Adds the sum of ``value`` over all rows before each one, in the given order.

    Ranges of the order are added up on their own; one number per range puts them together.
    """
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = T.StructType(
        [*rows.schema.fields, T.StructField("_range", T.LongType()), T.StructField("_sum", T.LongType())]
    )
    at = rows.columns.index(value)

    def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        so_far, number = 0, TaskContext.get().partitionId()
        for part in parts:
            sums = []
            for n in part.column(at).to_pylist():
                sums.append(so_far)
                so_far += n
            columns = [*part.columns, pa.array([number] * len(sums), pa.int64()), pa.array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=out.names)

    ordered = rows.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    local = stored(ordered.mapInArrow(add, out))
    ends = local.groupBy("_range").agg(F.max(F.col("_sum") + F.col(value)).alias("_end"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select("_range", F.coalesce(F.sum("_end").over(before), F.lit(0)).alias("_start"))
    whole = local.join(starts, "_range").withColumn(total, F.col("_start") + F.col("_sum"))
    return whole.drop("_range", "_sum", "_start")


def turns(conversations: DataFrame) -> DataFrame:
    """One row per turn with its node, and one per conversation (``path`` not null).

    A node's id is the digest of all turns up to it. Rows of a conversation are walked in
    the order of turn, then role and text; only the ids so far are held.
    """

    out = T._parse_datatype_string(
        "conv_id long, path binary, node binary, written string, loss_start long, loss_end long"
    )
    schema = to_arrow_schema(out)

    def walk(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, path = None, None

        def whole(rows: list[dict]) -> None:
            if path is not None:
                rows.append({"conv_id": conv, "path": bytes(path), "node": bytes(path[-_ID:])})

        for part in parts:
            rows: list[dict] = []
            for key, role, text in zip(*(c.to_pylist() for c in part.columns[:3]), strict=True):
                if path is None or key != conv:
                    whole(rows)
                    conv, path = key, bytearray()
                written, first, last = formatted(role, text)
                node = md5(path[-_ID:] + written.encode()).digest()
                path += node
                loss = (first, last) if role == LOSS_ROLE else (0, 0)
                rows.append(
                    {"node": node, "written": written, "loss_start": loss[0], "loss_end": loss[1]}
                )
            yield pa.RecordBatch.from_pylist(rows, schema=schema)
        rows = []
        whole(rows)
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    empty = F.lit("")
    columns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.coalesce("role", empty).alias("role"),
        F.coalesce("text", empty).alias("text"),
        "turn",
    )
    partitions = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = columns.repartition(partitions, "conv_id").sortWithinPartitions(
        "conv_id", F.col("turn").asc_nulls_first(), "role", "text"
    )
    return ordered.mapInArrow(walk, out)


def prefix_tree(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nodes, steps, ends) of all rows (conv_id, turn, role, text).

    Steps are the nodes on the way to each leaf, ends the leaf of each conversation.

    A node has its ``tree`` (root), ``parent``, ``depth``, the ``offset`` of its first token in
    the stream, the ``position`` of that token in its conversations, ``length``, the ``written``
    turn, the span of its text if that counts for the loss, and the ``ancestors`` as stretches
    (from, to) of the stream. Null role and text are empty; null conversation ids are one
    conversation; repeated rows are repeated turns; no rows give no nodes.
    """
    walked = stored(turns(conversations))
    ends = walked.filter("path IS NOT NULL").select("conv_id", F.col("node").alias("leaf"))
    texts = walked.filter("path IS NULL").groupBy("node").agg(
        *[F.first(c).alias(c) for c in ("written", "loss_start", "loss_end")]
    )
    # Depth-first order of the nodes is the order of their paths: first by the earliest path
    # through a node, then by depth.
    paths = walked.filter("path IS NOT NULL").groupBy(F.col("node").alias("leaf")).agg(
        F.first("path").alias("path"), F.lit(1).cast("long").alias("one")
    )
    ranked = running(paths, ["path"], "one", "rank").drop("one")
    depths = F.sequence(F.lit(0), (F.length("path") / _ID).cast("int") - 1)
    ids = F.transform(depths, lambda i: F.substring(F.col("path"), i * _ID + 1, F.lit(_ID)))
    steps = stored(ranked.select("leaf", "rank", F.posexplode(ids).alias("depth", "node")))
    placed = steps.groupBy("node").agg(F.min("rank").alias("rank"), F.first("depth").alias("depth"))
    lengths = texts.select("node", F.length("written").cast("long").alias("length"))
    laid = stored(running(placed.join(lengths, "node"), ["rank", "depth"], "length", "offset"))

    out = T._parse_datatype_string(
        "node binary, tree binary, parent binary, position long, "
        "ancestors array<struct<from: bigint, to: bigint>>"
    )
    schema = to_arrow_schema(out)

    def attend(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        line, stretches, tree, parent, position = None, [], None, None, 0
        for part in parts:
            rows = []
            for row in part.to_pylist():
                if row["line"] != line:
                    line, stretches, tree, parent, position = row["line"], [], row["node"], None, 0
                if row["rank"] == line:  # the path that lays the node out
                    own = [{"from": a, "to": b} for a, b in stretches]
                    rows.append(
                        {"node": row["node"], "tree": tree, "parent": parent, "position": position, "ancestors": own}
                    )
                first, after = row["offset"], row["offset"] + row["length"]
                if stretches and stretches[-1][1] == first:
                    stretches[-1] = (stretches[-1][0], after)
                else:
                    stretches.append((first, after))
                parent, position = row["node"], position + row["length"]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    partitions = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lines = steps.select(F.col("rank").alias("line"), "depth", "node").join(
        laid.select("node", "rank", "offset", "length"), "node"
    )
    lines = lines.repartition(partitions, "line").sortWithinPartitions("line", "depth")
    attended = lines.mapInArrow(attend, out)
    nodes = laid.drop("rank").join(attended, "node").join(texts, "node")
    return nodes, steps.select("leaf", "depth", "node"), ends


def read_back(nodes: DataFrame, steps: DataFrame, ends: DataFrame) -> DataFrame:
    """Per conversation, from the tree: digests of its turns and its loss text, and its length."""
    out = T._parse_datatype_string(
        "leaf binary, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long"
    )
    schema = to_arrow_schema(out)

    def digest(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaf, state = None, None

        def ended() -> dict:
            n, every, chars, loss, size = state
            values = leaf, n, every.hexdigest(), chars, loss.hexdigest(), size
            return dict(zip(out.names, values, strict=True))

        for part in parts:
            rows = []
            for row in part.to_pylist():
                if state is None or row["leaf"] != leaf:
                    if state:
                        rows.append(ended())
                    leaf, state = row["leaf"], [0, sha256(), 0, sha256(), 0]
                for role, text in parsed(row["written"]):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                masked = unescaped(row["written"][row["loss_start"] : row["loss_end"]])
                state[2] += len(masked)
                state[3].update(masked.encode())
                state[4] += len(row["written"])
            yield pa.RecordBatch.from_pylist(rows, schema=schema)
        if state:
            yield pa.RecordBatch.from_pylist([ended()], schema=schema)

    partitions = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lines = steps.join(nodes.select("node", "written", "loss_start", "loss_end"), "node")
    lines = lines.repartition(partitions, "leaf").sortWithinPartitions("leaf", "depth")
    return ends.join(lines.mapInArrow(digest, out), "leaf").drop("leaf")
