"""Chat formatting as a prefix tree.

Conversations that share their first turns share tree nodes: a node is a turn together with all turns before it, named
by a chained SHA-256. Each node's text is rendered once by the template and emitted once, in depth-first order, as a
run of tokens: the two control tokens and the vocabulary's ids in between. A node carries the position id of its first
token (the tokens of its ancestors in front of it), and the intervals of the emitted stream that it may attend to besides its own earlier
tokens: those of its ancestors, neighbouring ones merged. A conversation is its path of nodes.

Header and text of a turn are tokenized apart, so the loss mask of an assistant's node, the tokens from ``text_start`` to
its closing control token, covers its text exactly. Reading back starts from the stream: token ids are decoded, and every
node's position and intervals are held against the nodes before it on the path.

Depth-first order is the order of paths. A path lists only the nodes where the tree branches, so a long conversation that nobody
shares has a short path, and equal paths are ordered by depth. The order is a range sort over all nodes, and stream offsets are
prefix sums over the range partitions: a first turn that a third of all conversations share is one row, and its
subtree may span many tasks. A conversation passes through one task row by row and is never held as a whole.

The template is ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and texts ``<|`` gets a backslash, and backslashes
between ``<`` and ``|`` one more, so no text can close or open a turn, and reading back removes one. In roles, backslashes and
line breaks are written ``\\\\`` and ``\\n``. Loss falls on the texts of assistant turns.

Defined results: NULL text and NULL role count as empty; rows are ordered by turn (NULL first), then role and text, and repeated
rows are turns of their own. A NULL conv_id is a conversation like another. An empty table gives only the conversations added.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import batch_of, running_sums, slices, stored

START, END = "<|im_start|>", "<|im_end|>"
_OPEN, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<(\\*)\\\|")
_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + "\n", re.S)


def escape(text: str) -> str:
    return _OPEN.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m.group(1) == "n" else m.group(1), unescape(role))


def render(role: str, text: str) -> str:
    return f"{START}{escape_role(role)}\n{escape(text)}{END}\n"


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation."""
    out, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError(f"no turn begins at {at}")
        out.append((unescape_role(m.group(1)), unescape(m.group(2))))
        at = m.end()
    if at != len(formatted):
        raise ValueError(f"no turn begins at {at}")
    return out


@lru_cache(maxsize=1)
def _tokenizer(path: str):
    from tokenizers import Tokenizer
    made = Tokenizer.from_file(path)
    made.encode_special_tokens = True  # control strings of the vocabulary inside a text are ordinary text
    return made, made.get_vocab_size(with_added_tokens=True)


def _token_ids(formatted: list[str], path: str) -> tuple[list[np.ndarray], list[int]]:
    """Ids of rendered turns and where their texts start; the control strings are the two ids after the vocabulary's."""
    made, size = _tokenizer(path)
    cuts = [f.index("\n") + 1 for f in formatted]  # roles hold no line break
    heads = made.encode_batch_fast([f[len(START):c] for f, c in zip(formatted, cuts)], add_special_tokens=False)
    bodies = made.encode_batch_fast([f[c:-len(END) - 1] for f, c in zip(formatted, cuts)], add_special_tokens=False)
    return ([np.array([size, *h.ids, *b.ids, size + 1], np.int32) for h, b in zip(heads, bodies)],
            [1 + len(h.ids) for h in heads])


def _decoded(ids: list[list[int]], starts: list[int], path: str) -> list[tuple[str, str]]:
    """(role, text) of runs of token ids; a run that is not one turn is an error."""
    made, size = _tokenizer(path)
    if any(len(i) < 2 or i[0] != size or i[-1] != size + 1 or max(i[1:-1], default=0) >= size for i in ids):
        raise ValueError("a node is not one turn between its control tokens")
    heads = made.decode_batch([i[1:a] for i, a in zip(ids, starts)], skip_special_tokens=False)
    bodies = made.decode_batch([i[a:-1] for i, a in zip(ids, starts)], skip_special_tokens=False)
    if not all(h.endswith("\n") for h in heads):
        raise ValueError("a text does not start behind its role")
    return [(unescape_role(h[:-1]), unescape(b)) for h, b in zip(heads, bodies)]


#: (conv_no, depth, node, parent, role, text) of every turn.
TURNS = T.StructType([
    T.StructField("conv_no", T.LongType()), T.StructField("depth", T.IntegerType()), T.StructField("node", T.StringType()),
    T.StructField("parent", T.StringType()), T.StructField("formatted", T.StringType()), T.StructField("loss", T.BooleanType())])
#: Where nodes stand on the path of the conversation that shows them.
PLACES = T.StructType([
    T.StructField("node", T.StringType()), T.StructField("path", T.StringType()), T.StructField("depth", T.IntegerType()),
    T.StructField("n_tokens", T.LongType()), T.StructField("position", T.LongType()), T.StructField("shown_by", T.LongType())])
TOKENS = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("text_start", T.LongType()),
                       T.StructField("token_ids", T.ArrayType(T.IntegerType()))])


def _turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_no, conv_id) and the turns with their nodes, both from the stored turns."""
    said = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    schema = T.StructType([conversations.schema["conv_id"], *TURNS.fields])

    def chain(batches):
        conv, no, depth, parent = object(), TaskContext.get().partitionId() << 33, 0, ""
        for batch in batches:
            rows = []
            for own_id, role, text in zip(*[column.to_pylist() for column in batch.columns]):
                if own_id != conv:
                    conv, no, depth, parent = own_id, no + 1, 0, ""
                own = f"{parent}\n{len(role)}\n{role}\n{text}".encode("utf-8", "surrogatepass")
                node = hashlib.sha256(own).hexdigest()[:40]
                rows.append((conv, no, depth, node, parent, render(role, text), role == "assistant"))
                depth, parent = depth + 1, node
                if len(rows) >= 2000:
                    yield batch_of(schema, [list(c) for c in zip(*rows)])
                    rows = []
            if rows:
                yield batch_of(schema, [list(c) for c in zip(*rows)])

    sorted_turns = said.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    turns = stored(sorted_turns.select("conv_id", "role", "text").mapInArrow(chain, schema), "turns")
    return turns.where("depth = 0").select("conv_no", "conv_id"), turns.drop("conv_id")


def prefix_tree(conversations: DataFrame, vocabulary: str) -> tuple[DataFrame, DataFrame]:
    """Nodes (node, parent, depth, formatted, loss, token_ids, text_start, n_tokens, stream_start, position, attends) in one
    depth-first token stream, and the paths (conv_id, conv_no, depth, node)."""
    names, turns = _turns(conversations)
    nodes = turns.groupBy("node").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.first("formatted").alias("formatted"),
        F.first("loss").alias("loss"), F.min("conv_no").alias("shown_by"))

    schema = T.StructType([*nodes.schema.fields, *TOKENS.fields])
    at = nodes.columns.index("formatted")

    def tokens(batches):
        for batch in batches:
            for a, b in slices(pc.binary_length(batch.column(at)).to_pylist(), 1 << 18):
                part = batch.slice(a, b - a)
                ids, starts = _token_ids(part.column(at).to_pylist(), vocabulary)
                yield batch_of(schema, [*part.columns, [len(i) for i in ids], starts, ids])

    nodes = stored(nodes.mapInArrow(tokens, schema), "nodes")
    # where the tree branches: below a parent of several children, and at the first turns
    sizes = stored(nodes.where("depth > 0").groupBy("parent").agg(F.count("*").alias("children")).where("children > 1"), "branches")
    marked = nodes.select("node", "parent", "depth", "shown_by", "n_tokens").join(sizes, "parent", "left").withColumn(
        "branch", F.when(F.col("children").isNotNull() | (F.col("depth") == 0), F.substring("node", 1, 16)))
    marked = stored(marked.select("node", "branch", "n_tokens", "shown_by"), "marked")
    # turns are merged with what they are joined to, never broadcast: where many conversations share nodes, a stored turn is a few
    # bytes, by which Spark sizes it, and two hundred in the driver's tables
    walked = turns.select("conv_no", "depth", "node").join(marked.hint("merge"), "node")
    walked = walked.repartition("conv_no").sortWithinPartitions("conv_no", "depth")

    def walk(batches):
        conv, path, position = None, "", 0
        for batch in batches:
            rows = []
            for c, depth, node, branch, n, shown_by in zip(*[column.to_pylist() for column in batch.columns]):
                if c != conv:
                    conv, path, position = c, "", 0
                path += branch or ""
                if c == shown_by:
                    rows.append((node, path, depth, n, position, shown_by))
                position += n
            if rows:
                yield batch_of(PLACES, [list(c) for c in zip(*rows)])

    placed = walked.select("conv_no", "depth", "node", "branch", "n_tokens", "shown_by").mapInArrow(walk, PLACES)
    placed = stored(running_sums(placed, ["path", "depth", "node"], "n_tokens", "stream_start"), "stream")

    # the ancestors' places in the stream, neighbouring ones merged: along one conversation per node
    spans = T.StructType([T.StructField("node", T.StringType()), T.StructField("attends", T.ArrayType(T.ArrayType(T.LongType())))])

    def ancestors(batches):
        conv, held = None, []
        for batch in batches:
            names, attends = [], []
            for c, node, start, n, own in zip(*[column.to_pylist() for column in batch.columns]):
                if c != conv:
                    conv, held = c, []
                if own:
                    names.append(node)
                    attends.append([list(h) for h in held])
                _joined(held, start, start + n)
            yield batch_of(spans, [names, attends])

    shown = turns.select("conv_no", "depth", "node").join(
        placed.select("node", "stream_start", "n_tokens", "shown_by").hint("merge"), "node").withColumn("own", F.expr("conv_no = shown_by"))
    # only conversations that some node is shown by
    needed = placed.select(F.col("shown_by").alias("conv_no")).distinct()
    walks = shown.join(needed.hint("merge"), "conv_no", "left_semi").repartition("conv_no").sortWithinPartitions("conv_no", "depth")
    attends = walks.select("conv_no", "node", "stream_start", "n_tokens", "own").mapInArrow(ancestors, spans)
    full = nodes.select("node", "parent", "depth", "formatted", "loss", "token_ids", "text_start", "n_tokens").join(
        placed.select("node", "stream_start", "position"), "node").join(attends, "node")
    paths = turns.select("conv_no", "depth", "node").join(names.hint("merge"), "conv_no")
    return stored(full, "tree"), stored(paths, "paths")


READ = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()),
    T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()),
    T.StructField("formatted_chars", T.LongType())])


def _joined(held: list[tuple[int, int]], start: int, end: int) -> None:
    """Adds an interval behind those held, merged with its neighbour."""
    if held and held[-1][1] == start:
        held[-1] = (held[-1][0], end)
    else:
        held.append((start, end))


SAID = T.StructType([T.StructField("node", T.StringType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
                     T.StructField("chars", T.LongType())])


def read_back(tree: DataFrame, paths: DataFrame, vocabulary: str) -> DataFrame:
    """Each conversation put together again from the tokens of the nodes on its path, and digested. A node whose position or
    intervals are not those of the nodes before it is an error."""
    def decode(batches):
        for batch in batches:
            for a, b in slices(pc.list_value_length(batch.column(1)).to_pylist(), 1 << 16):
                part = batch.slice(a, b - a)
                said = _decoded(part.column(1).to_pylist(), part.column(2).to_pylist(), vocabulary)
                yield batch_of(SAID, [part.column(0), [r for r, _ in said], [t for _, t in said], [len(render(r, t)) for r, t in said]])

    said = stored(tree.select("node", "token_ids", "text_start").mapInArrow(decode, SAID), "said")
    places = tree.select("node", "loss", "stream_start", "n_tokens", "position", "attends").join(said, "node")
    turns = paths.select("conv_no", "conv_id", "depth", "node").join(places.hint("merge"), "node")
    turns = turns.repartition("conv_no").sortWithinPartitions("conv_no", "depth")

    def digest(batches):
        no, conv, n, chain, loss_chars, loss, chars, tokens, held = None, None, 0, None, 0, None, 0, 0, []
        for batch in batches:
            rows = []
            for c, own_id, role, text, size, counts, start, many, position, attends in zip(*[x.to_pylist() for x in batch.columns]):
                if c != no:
                    if no is not None:
                        rows.append((conv, n, chain.hexdigest(), loss_chars, loss.hexdigest(), chars))
                    no, conv, n, chain, loss_chars, loss, chars = c, own_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0
                    tokens, held = 0, []
                if position != tokens or [tuple(a) for a in attends] != held:
                    raise ValueError(f"turn {n} of conversation {own_id} does not follow the nodes it attends to")
                _joined(held, start, start + many)
                tokens, n, chars = tokens + many, n + 1, chars + size
                chain.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                if counts:
                    loss_chars += len(text)
                    loss.update(text.encode("utf-8", "surrogatepass"))
            if rows:
                yield batch_of(READ, [list(c) for c in zip(*rows)])
        if no is not None:
            yield batch_of(READ, [[x] for x in (conv, n, chain.hexdigest(), loss_chars, loss.hexdigest(), chars)])

    return turns.select("conv_no", F.col("conv_id").cast("long"), "role", "text", "chars", "loss", "stream_start", "n_tokens",
                        "position", "attends").mapInArrow(digest, READ)
