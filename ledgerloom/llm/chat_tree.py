"""Chat formatting into prefix trees.

Conversations that begin with the same turns share those turns' tokens. Each
turn is a node, named by a 128-bit hash of all turns up to it, so equal nodes
mean equal beginnings. Sorted by the path of node names, conversations lie in
depth-first order of the tree. Tasks stream them in that order into packs of
bounded length and emit a node's tokens once a pack; every node carries the
position of its first token in its conversation and the intervals of the pack
that it may attend to, which are its ancestors. Any number of conversations
with one beginning just fills more packs. A long conversation is cut into parts
of bounded length, which go to packs of their own: a part's base is the name of
the node before it, so parts with equal beginnings lie together too, and
positions run on from part to part. No task holds more than a part.

The token unit here is the code point; a tokenizer may cut each node's text
further, as nodes end at turn borders.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` a turn. Inside texts a ``<``,
any number of backslashes and ``|`` get one more backslash, so no marker can
occur there; in roles backslash, newline and ``|`` are written \\\\, \\n and \\p.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
_ROLE_OUT = {"\\": "\\\\", "\n": "\\n", "|": "\\p"}
_ROLE_IN = {v[1]: k for k, v in _ROLE_OUT.items()}


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return re.sub(r"[\\\n|]", lambda m: _ROLE_OUT[m[0]], role)


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: _ROLE_IN[m[1]], role)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn's tokens, and where its text begins and ends in them."""
    head = f"{START}{escape_role(role)}\n"
    body = escape(text)
    return f"{head}{body}{END}\n", len(head), len(head) + len(body)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        line = formatted.index("\n", at)
        end = formatted.index(END, line)
        if not formatted.startswith(START, at) or formatted[end + len(END)] != "\n":
            raise ValueError("not a formatted conversation")
        turns.append((unescape_role(formatted[at + len(START):line]), unescape(formatted[line + 1:end])))
        at = end + len(END) + 1
    return turns


class Node(NamedTuple):
    """A node's place in its pack, its first position id, the text to learn from (none: both 0)
    and its ancestors' tokens as [start, end) pairs, flattened."""

    start: int
    length: int
    position: int
    loss_start: int
    loss_end: int
    attends: list[int]


_TURNS = "base binary, path binary, conv_id long, position long, ends boolean, roles array<string>, texts array<string>"
_NODE = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("position", pa.int64()),
                   ("loss_start", pa.int64()), ("loss_end", pa.int64()), ("attends", pa.list_(pa.int64()))])
_PACKS = ("tokens string, nodes array<struct<start:long,length:long,position:long,loss_start:long,loss_end:long,"
          "attends:array<long>>>, conv_ids array<long>, leaves array<int>, base binary, tails array<binary>")


def _paths(part_chars: int):
    """One row a part of a conversation, from rows sorted by conversation and turn."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("base", pa.binary()), ("path", pa.binary()), ("conv_id", pa.int64()), ("position", pa.int64()),
                            ("ends", pa.bool_()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))])
        out: list[tuple] = []
        held, current, began = 0, None, False
        base, path, roles, texts, first, length, size = b"", bytearray(), [], [], 0, 0, 0

        def flush() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            out.clear()
            return made

        for batch in rows:
            for conv, role, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                other = not began or conv != current
                if other or size + len(text) + 64 > part_chars:
                    if began:
                        out.append((base, bytes(path), current, first, other, roles, texts))
                    # Cuts depend on the turns so far only: equal beginnings have equal parts.
                    base, first = (b"", 0) if other else (bytes(path[-16:]), first + length)
                    path, roles, texts, length, size, current, began = bytearray(), [], [], 0, 0, conv, True
                    if held > 1 << 22 or len(out) >= 1024:
                        yield flush()
                        held = 0
                name = xxhash.xxh3_128(bytes(path[-16:]) or base)
                name.update(b"%d:" % len(role.encode()))
                name.update(role.encode())
                name.update(text.encode())
                path += name.digest()
                roles.append(role)
                texts.append(text)
                length += len(START) + len(escape_role(role)) + len(escape(text)) + len(END) + 2
                size += len(text) + 64
                held += len(text) + 64
        if began:
            out.append((base, bytes(path), current, first, True, roles, texts))
        if out:
            yield flush()
    return run


def _pack(pack_chars: int, pack_members: int, learn_roles: frozenset):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, nodes, convs, leaves, tails = [], [], [], [], []
        size, trail, before, root = 0, [], b"", b""  # trail: the nodes of the conversation before

        def flush() -> pa.RecordBatch:
            nonlocal parts, nodes, convs, leaves, tails, size, trail, before
            made = pa.RecordBatch.from_arrays(
                [pa.array(["".join(parts)]), pa.array([[n._asdict() for n in nodes]], pa.list_(_NODE)),
                 pa.array([convs], pa.list_(pa.int64())), pa.array([leaves], pa.list_(pa.int32())),
                 pa.array([root], pa.binary()), pa.array([tails], pa.list_(pa.binary()))],
                ["tokens", "nodes", "conv_ids", "leaves", "base", "tails"])
            parts, nodes, convs, leaves, tails, size, trail, before = [], [], [], [], [], 0, [], b""
            return made

        for batch in rows:
            for base, path, conv, first, ends, roles, texts in zip(*(c.to_pylist() for c in batch.columns)):
                def shared() -> int:
                    most = min(len(path), len(before)) // 16
                    return next((i for i in range(most) if path[16 * i:16 * i + 16] != before[16 * i:16 * i + 16]), most)
                depth = shared()
                new = sum(map(len, texts[depth:]))
                if convs and (base != root or (depth < len(roles) and size + new > pack_chars) or len(convs) >= pack_members):
                    yield flush()
                    depth = 0
                root = base
                trail = trail[:depth]
                for role, text in zip(roles[depth:], texts[depth:]):
                    formatted, low, high = format_turn(role, text)
                    if trail:
                        up = nodes[trail[-1]]
                        attends = list(up.attends)
                        if attends and attends[-1] == up.start:
                            attends[-1] += up.length
                        else:
                            attends += [up.start, up.start + up.length]
                        position = up.position + up.length
                    else:
                        attends, position = [], first
                    loss = (low, high) if role in learn_roles else (0, 0)
                    trail.append(len(nodes))
                    nodes.append(Node(size, len(formatted), position, *loss, attends))
                    parts.append(formatted)
                    size += len(formatted)
                convs.append(conv)
                leaves.append(trail[-1])
                tails.append(None if ends else path[-16:])
                before = path
        if convs:
            yield flush()
    return run


def read_back(tokens: str, nodes: list[dict], leaf: int) -> tuple[str, list[str]]:
    """A conversation, or its part in this pack, as its leaf sees it: the formatted text, and the unescaped texts under the loss mask."""
    last = nodes[leaf]
    at = [*last["attends"], last["start"], last["start"] + last["length"]]
    formatted = "".join(tokens[a:b] for a, b in zip(at[::2], at[1::2]))
    spans = list(zip(at[::2], at[1::2]))
    low, chain = 0, []
    starts = [n["start"] for n in nodes]
    from bisect import bisect_left
    for a, b in spans:  # the nodes that lie in the intervals, in order
        low = bisect_left(starts, a)
        while low < len(nodes) and starts[low] < b:
            chain.append(nodes[low])
            low += 1
    if len(formatted) != last["position"] + last["length"] - chain[0]["position"]:
        raise ValueError("positions and attention intervals disagree")
    learned = [unescape(tokens[n["start"] + n["loss_start"]:n["start"] + n["loss_end"]]) for n in chain if n["loss_end"]]
    return formatted, learned


def packs(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text", learn_roles: tuple = ("assistant",), pack_chars: int = 1 << 16,
          pack_members: int = 1024, part_chars: int = 1 << 21) -> DataFrame:
    """One row a pack: ``tokens, nodes, conv_ids, leaves, base, tails``.

    ``nodes`` lists each node's place, position id, loss span and attention
    intervals (see :class:`Node`); ``leaves[i]`` is the node that ends
    conversation ``conv_ids[i]``. A pack holds up to ``pack_chars`` characters
    of text and ``pack_members`` conversations, one conversation at least.

    A conversation of over ``part_chars`` characters (a turn counts 64 more) is
    in several packs. ``tails[i]`` is then the name of the leaf that its next
    part goes on from, and null where the conversation ends; ``base`` is that
    name in the pack of the next part, and empty where conversations begin. A
    node also attends to all tokens of the earlier parts, which the position id
    of its pack's first node counts.

    Turns go by turn number, null first, then by role and text; repeated rows
    are turns of their own. Null texts and roles count as empty; rows with a
    null conv_id form one conversation with a null id. A task sorts and streams
    the turns of a conversation and holds one part of it. An empty table gives
    no packs; other columns are ignored.
    """
    rows = conversations.select(
        F.col(f"`{conv_col}`").cast("long").alias("conv_id"), F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"), F.col(f"`{turn_col}`").cast("long").alias("turn"))
    paths = (rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
             .select("conv_id", "role", "text").mapInArrow(_paths(part_chars), _TURNS))
    order = ["base", "path", "conv_id"]
    return (paths.repartitionByRange(*order).sortWithinPartitions(*order)
            .mapInArrow(_pack(pack_chars, pack_members, frozenset(learn_roles)), _PACKS))


def digests(packs: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)`` of each conversation
    read back from :func:`packs`; those in several packs are streamed part by part."""
    columns = [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
               ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
    result = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def made(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def read(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([*columns, ("position", pa.int64()), ("turns", pa.string()), ("loss", pa.string())])
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        for batch in rows:
            for tokens, nodes, convs, leaves, base, tails in zip(*(c.to_pylist() for c in batch.columns)):
                out, held, known = [], 0, {}
                for conv, leaf, tail in zip(convs, leaves, tails):
                    whole = not base and tail is None
                    if (leaf, whole) not in known:
                        formatted, learned = read_back(tokens, nodes, leaf)
                        pairs, loss = parse(formatted), "".join(learned)
                        text = "".join(f"{r}\n{t}\n" for r, t in pairs)
                        position = nodes[leaf]["position"] + nodes[leaf]["length"] - len(formatted)
                        known[leaf, whole] = (
                            (len(pairs), sha(text), len(loss), sha(loss), len(formatted), position, None, None) if whole else
                            (len(pairs), None, len(loss), None, len(formatted), position, text, loss))
                    out.append((conv, *known[leaf, whole]))
                    held += 0 if whole else len(known[leaf, whole][6])
                    if held > 1 << 22:
                        yield made(out, schema)
                        out, held = [], 0
                if out:
                    yield made(out, schema)

    def joined(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, out, current, open_ = pa.schema(columns), [], None, False
        turns, n, turn_sha, chars, loss_sha = 0, 0, None, 0, None
        for batch in rows:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if open_ and row[0] != current:
                    out.append((current, turns, turn_sha.hexdigest(), chars, loss_sha.hexdigest(), n))
                    open_ = False
                if row[7] is None:
                    if row[6]:
                        raise ValueError("a whole conversation begins at position 0")
                    out.append(row[:6])
                else:
                    if not open_:
                        current, open_, turns, chars, n = row[0], True, 0, 0, 0
                        turn_sha, loss_sha = hashlib.sha256(), hashlib.sha256()
                    if row[6] != n:
                        raise ValueError("the parts of a conversation do not follow each other")
                    turns, chars, n = turns + row[1], chars + row[3], n + row[5]
                    turn_sha.update(row[7].encode())
                    loss_sha.update(row[8].encode())
            if out:
                yield made(out, schema)
                out = []
        if open_:
            yield made([(current, turns, turn_sha.hexdigest(), chars, loss_sha.hexdigest(), n)], schema)

    pieces = packs.mapInArrow(read, result + ", position long, turns string, loss string")
    return (pieces.repartition("conv_id").sortWithinPartitions("conv_id", "position").mapInArrow(joined, result))
