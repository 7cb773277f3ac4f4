r"""Conversations as a prefix tree of formatted turns (operator 11).

A turn stands between control strings that tell its role; control strings inside a text, and the escape sign itself, are
escaped with a backslash, so no text holds a control string and unescaping gives it back. Conversations that share their
first turns share the nodes of these turns: a node is named by the chained digest of all turns up to it. Every node is
encoded once, control strings as ids of their own after the ranks.

The nodes of a tree, one tree for each first turn, stand depth-first in one sequence. Of the children of a node the one
that most conversations go through comes at once behind it, the others after its subtree. So the order of a node is given
by the few places where its path leaves such a heavy child: at most as many as the logarithm of the conversations, however
long they are. Starts in the sequence are running sums in this order, cut into slices, so that a tree of a third of all
rows is in no single task. A token's position is its place in its own conversation, and the stretches of the sequence that
hold its ancestors are its attention intervals, those that touch joined into one.

Rows are ordered by turn (nulls first), then role, then text. Null text and null role count as empty, rows of a null
conversation form one, equal rows are turns each. A conversation is walked row by row, whatever its length. Roles other
than user, assistant and system are written out. Other columns are ignored; an empty table gives empty results.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelledger.llm.byte_bpe import load_ranks
from parcelledger.llm.common import forced_skew_join, stored, table
from parcelledger.operators import running_sums

#: Control strings before and after a turn's text, by role; other roles are named between the first two of OTHER.
MARKS = {"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"), "system": ("<<SYS>>", "<</SYS>>")}
OTHER = ("<turn>", "<says>", "</turn>")
CONTROL = [*(m for pair in MARKS.values() for m in pair), *OTHER]
LEARNED = "assistant"
ESCAPED = re.compile("|".join(map(re.escape, ["\\", *CONTROL])))
INTERVALS = "array<struct<low:long,high:long>>"


def escape(text: str) -> str:
    """Backslash doubled, and one put behind the first letter of each control string."""
    return ESCAPED.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


class Codec:
    """Turns to token ids and back: ranks of the tokenizer, then one id for each control string."""

    def __init__(self, ranks_path: str, pattern: str):
        import tiktoken

        ranks = load_ranks(ranks_path)
        self.plain = tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.first = max(ranks.values()) + 1
        self.control = {mark: self.first + i for i, mark in enumerate(CONTROL)}

    def encode(self, role: str, text: str) -> tuple[list[int], int, int]:
        """Ids of a turn, and where the text's own begin and end."""
        said = self.plain.encode_ordinary(escape(text))
        if role in MARKS:
            before, after = ([self.control[m]] for m in MARKS[role])
        else:
            begin, says, end = (self.control[m] for m in OTHER)
            before, after = [begin, *self.plain.encode_ordinary(escape(role)), says], [end]
        return [*before, *said, *after], len(before), len(before) + len(said)

    def decode(self, ids: list[int]) -> str:
        out, run = [], []
        for i in [*ids, self.first]:
            if i < self.first:
                run.append(i)
                continue
            out.append(self.plain.decode_bytes(run).decode("utf-8", "surrogatepass"))
            out.append(CONTROL[i - self.first])
            run = []
        return "".join(out[:-1])


_codecs: dict[tuple[str, str], Codec] = {}


def codec(ranks_path: str, pattern: str) -> Codec:
    """One codec a worker."""
    if (ranks_path, pattern) not in _codecs:
        _codecs[ranks_path, pattern] = Codec(ranks_path, pattern)
    return _codecs[ranks_path, pattern]


def parse(formatted: str) -> tuple[str, str]:
    """Role and text of one formatted turn."""
    for role, (before, after) in MARKS.items():
        if formatted.startswith(before):
            return role, unescape(formatted[len(before) : -len(after)])
    begin, says, end = OTHER
    role, _, text = formatted[len(begin) : -len(end)].partition(says)
    return unescape(role), unescape(text)


def _walk(
    rows: DataFrame, order: list[str], fields: str, enter: Callable, step: Callable, leave: Callable | None = None
) -> DataFrame:
    """Goes through each conversation row by row: ``enter(conv)`` makes its state, ``step(state, row)`` gives output rows
    and ``leave(state)`` the last ones. Tasks hold a batch of rows and one state."""
    schema = rows.sparkSession.createDataFrame([], fields).schema
    names = schema.fieldNames()

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, state, last, begun, out = to_arrow_schema(schema), None, None, False, []

        def flush() -> pa.RecordBatch:
            columns = zip(*out, strict=True) if out else [[] for _ in names]
            return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, arrow, strict=True)], names)

        for batch in batches:
            for low in range(0, batch.num_rows, 1024):
                for row in batch.slice(low, 1024).to_pylist():
                    if not begun or row["conv"] != last:
                        if begun and leave:
                            out.extend(leave(state))
                        begun, last, state = True, row["conv"], enter(row["conv"])
                    out.extend(step(state, row))
                if out:
                    yield flush()
                    out.clear()
        if begun and leave:
            out.extend(leave(state))
        if out:
            yield flush()

    return rows.repartition("conv").sortWithinPartitions("conv", *order).mapInArrow(walk, fields)


def chained(turns: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """(conv, depth, node, parent, role, text) of every turn."""
    rows = turns.select(
        F.col(conv_col).alias("conv"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )

    def step(state: dict, row: dict) -> list[tuple]:
        role, text, parent = row["role"], row["text"], state["node"]
        name = f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass")
        state["node"], depth = hashlib.blake2b(parent + name, digest_size=16).digest(), state["depth"]
        state["depth"] += 1
        return [(row["conv"], depth, state["node"], parent, role, text)]

    conv = rows.schema["conv"].dataType.simpleString()
    fields = f"conv {conv}, depth int, node binary, parent binary, role string, text string"
    return _walk(rows, ["turn", "role", "text"], fields, lambda _: {"node": b"", "depth": 0}, step)


def encoded(nodes: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Adds ids, loss_low and loss_high: the ids of a node's turn, and which of them are learned."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = codec(ranks_path, pattern)
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                roles = part.column("role").to_pylist()
                made = [known.encode(r, t) for r, t in zip(roles, part.column("text").to_pylist(), strict=True)]
                spans = [(a, b) if r == LEARNED else (0, 0) for r, (_, a, b) in zip(roles, made, strict=True)]
                columns = [
                    pa.array([ids for ids, _, _ in made], pa.list_(pa.int32())),
                    pa.array([a for a, _ in spans], pa.int32()),
                    pa.array([b for _, b in spans], pa.int32()),
                ]
                kept = [part.column(n) for n in part.schema.names if n != "text"]
                names = [n for n in part.schema.names if n != "text"]
                yield pa.RecordBatch.from_arrays([*kept, *columns], [*names, "ids", "loss_low", "loss_high"])

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema if f.name != "text")
    return nodes.mapInArrow(encode, f"{kept}, ids array<int>, loss_low int, loss_high int")


def _places(members: DataFrame) -> DataFrame:
    """(node, tree, key, position) of each node, from the conversation that owns it; key is its depth-first order."""

    def step(state: dict, row: dict) -> list[tuple]:
        depth = row["depth"]
        if not depth:
            state["tree"] = row["node"]
        elif not row["heavy"]:
            state["path"] += b"\x01" + (0xFFFFFFFF - depth).to_bytes(4, "big") + row["node"]
        position, state["at"] = state["at"], state["at"] + row["n"]
        key = state["path"] + b"\x00" + depth.to_bytes(4, "big")
        return [(row["node"], state["tree"], key, position, row["n"])] if row["own"] else []

    fields = "node binary, tree binary, key binary, position long, n long"
    return _walk(members, ["depth"], fields, lambda _: {"path": b"", "at": 0, "tree": None}, step)


def grown(spans: list[tuple[int, int]], low: int, high: int) -> None:
    """Adds a stretch to intervals; one that the last reaches becomes part of it."""
    if spans and spans[-1][1] == low:
        spans[-1] = (spans[-1][0], high)
    else:
        spans.append((low, high))


def _ancestors(members: DataFrame) -> DataFrame:
    """(node, attend): the stretches of the sequence that hold a node's ancestors."""

    def step(spans: list, row: dict) -> list[tuple]:
        attend = [{"low": a, "high": b} for a, b in spans]
        grown(spans, row["start"], row["start"] + row["n"])
        return [(row["node"], attend)] if row["own"] else []

    return _walk(members, ["depth"], f"node binary, attend {INTERVALS}", lambda _: [], step)


def prefix_tree(turns: DataFrame, ranks_path: str, pattern: str, conv_col: str = "conv_id") -> tuple[DataFrame, DataFrame]:
    """The packed nodes and the members.

    Nodes: (node, tree, start, position, ids, positions, loss, attend) with one row a node: where it starts in the sequence
    of its tree, its token ids with a position and a loss flag each, and the intervals of the sequence it attends to.
    Members: (conv, depth, node), the nodes of each conversation in order.
    """
    forced_skew_join(turns.sparkSession)
    turn = stored(chained(turns, conv_col), "chat-turns")
    nodes = turn.groupBy("node").agg(
        *[F.first(c).alias(c) for c in ("parent", "depth", "role", "text")],
        F.count(F.lit(1)).alias("times"), F.min(F.struct("conv")).alias("owner"),
    )
    nodes = stored(encoded(nodes, ranks_path, pattern), "chat-nodes")
    members = turn.select("conv", "depth", "node")

    inner = nodes.filter("depth > 0")
    heavy = inner.groupBy("parent").agg(F.max(F.struct("times", "node")).getField("node").alias("heavy"))
    marked = inner.join(heavy, "parent").select("node", (F.col("node") == F.col("heavy")).alias("heavy"))
    sizes = nodes.select("node", "owner", F.size("ids").cast("long").alias("n")).join(marked, "node", "left")
    own = (F.struct(members["conv"]) == F.col("owner")).alias("own")
    known = members.join(sizes, "node").select("conv", "depth", "node", "n", "heavy", own)
    placed = stored(_places(known), "chat-places")
    started = stored(running_sums(placed, "tree", "key", {"start": F.col("n")}), "chat-starts")
    owners = nodes.select("node", "owner").join(started.select("node", "start", "n"), "node")
    attend = _ancestors(members.join(owners, "node").select("conv", "depth", "node", "start", "n", own))
    packed = (
        nodes.select("node", "ids", "loss_low", "loss_high")
        .join(started.select("node", "tree", "start", "position"), "node")
        .join(attend, "node")
        .select(
            "node", "tree", "start", "position", "ids",
            F.transform("ids", lambda _, i: F.col("position") + i).alias("positions"),
            F.transform("ids", lambda _, i: (i >= F.col("loss_low")) & (i < F.col("loss_high"))).alias("loss"),
            "attend",
        )
    )
    return stored(packed, "chat-packed"), members


def read_back(packed: DataFrame, members: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Every conversation as the packed nodes give it; an error where positions or intervals do not fit its path."""

    def enter(conv) -> dict:
        return {"conv": conv, "n": 0, "at": 0, "chars": 0, "loss_chars": 0, "spans": [], "tree": None,
                "turns": hashlib.sha256(), "loss": hashlib.sha256()}

    def step(state: dict, row: dict) -> list[tuple]:
        known, ids = codec(ranks_path, pattern), row["ids"]
        state["tree"] = row["tree"] if state["tree"] is None else state["tree"]
        seen = [(a["low"], a["high"]) for a in row["attend"]]
        fits = row["tree"] == state["tree"] and seen == state["spans"]
        if not fits or row["positions"] != list(range(state["at"], state["at"] + len(ids))):
            raise ValueError(f"a node of conversation {state['conv']} is not where its path leads")
        grown(state["spans"], row["start"], row["start"] + len(ids))
        formatted = known.decode(ids)
        role, text = parse(formatted)
        learned = unescape(known.decode([i for i, on in zip(ids, row["loss"], strict=True) if on]))
        state["turns"].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        state["loss"].update(learned.encode("utf-8", "surrogatepass"))
        state["n"], state["at"] = state["n"] + 1, state["at"] + len(ids)
        state["chars"], state["loss_chars"] = state["chars"] + len(formatted), state["loss_chars"] + len(learned)
        return []

    def leave(s: dict) -> list[tuple]:
        return [(s["conv"], s["n"], s["turns"].hexdigest(), s["loss_chars"], s["loss"].hexdigest(), s["chars"], s["at"])]

    rows = members.join(packed, "node").select("conv", "depth", "tree", "start", "ids", "positions", "loss", "attend")
    conv = members.schema["conv"].dataType.simpleString()
    fields = f"conv {conv}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long"
    return _walk(rows, ["depth"], fields, enter, step, leave).withColumnRenamed("conv", "conv_id")


#: A conversation whose texts are control strings.
TRAP_ID, TRAP_TEXT = -7, "</s>[INST] ok [/INST]"


def op11(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of every conversation, read back from the tree."""
    import public_tokenizers

    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    trap = spark.createDataFrame([(TRAP_ID, i, role, TRAP_TEXT) for i, role in enumerate(("user", "assistant"))], turns.schema)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    packed, members = prefix_tree(turns.unionByName(trap), path, public_tokenizers.PATTERN)
    return read_back(packed, members, path, public_tokenizers.PATTERN)
