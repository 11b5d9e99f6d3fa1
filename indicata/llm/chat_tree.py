"""Chat formatting as prefix trees: turns that conversations share at their start are emitted once.

A node of a tree is a turn after given earlier turns. Conversations are sorted by their path of nodes, which
is depth-first order, and each sorted partition is read as a stream: a conversation adds the turns that
the one before it does not have, and is otherwise the same tokens. A pack is such a stream; the next one repeats the
turns that its first conversation shares with the one before, and ends once it has added ``pack_chars`` of its own, or
as many as it repeats if these are more. So a partition's packs have at most twice the text that its tree has, a
first turn of any number of conversations spreads over packs and tasks, and a task holds one pack, of a size that
follows ``pack_chars`` and its longest conversation.

The unit ("token") is a code point of the formatted text. A pack's row has the text, and per node its
span, its parent, the position id of its first token (its depth in tokens), the spans of its ancestors and
of itself (a token attends to these up to itself and to nothing else), and the span of its text if the turn
is under the loss mask. Conversations of equal turns are one leaf; ``members`` maps ids to leaves.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` per turn. Inside roles and texts every ``<``, any
backslashes, ``|`` gets one more backslash, so no control string occurs there and removing one restores it;
in roles a backslash and a line feed are written as two characters.

Null texts and roles are empty; a null turn number sorts first; rows of one turn number sort by role and
text; repeated rows are turns of their own; a null ``conv_id`` is one conversation. Empty tables give no
rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicata.llm import common as C

START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"
PACK_CHARS = 1 << 15

_ESCAPE, _UNESCAPE = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    """``text`` without control strings; ``unescape`` restores it."""
    return _ESCAPE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """A turn's formatted text, and where its own text begins and ends in it."""
    name = escape(role).replace("\\", "\\\\").replace("\n", "\\n")
    body = escape(text)
    begin = len(START) + len(name) + 1
    return f"{START}{name}\n{body}{END}\n", begin, begin + len(body)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    turns = []
    for turn in formatted.split(START)[1:]:
        name, _, rest = turn.partition("\n")
        role = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], name)
        turns.append((unescape(role), unescape(rest[: -len(END) - 1])))
    return turns


def conversations(df: DataFrame) -> DataFrame:
    """One row per ``conv_id``: its ``turns`` in order, their ``key`` and ``path``."""
    turn = F.struct("turn", C.null_to("role", "").alias("role"), C.null_to("text", "").alias("text"))
    grouped = df.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def paths(turns: pd.Series) -> pd.DataFrame:
        found = []
        for conversation in turns:
            digest, path = hashlib.sha256(), []
            for t in conversation:
                for part in (t["role"], t["text"]):
                    data = part.encode()
                    digest.update(len(data).to_bytes(8, "little") + data)
                path.append(digest.hexdigest()[:24])
            found.append((digest.hexdigest(), "".join(path)))
        return pd.DataFrame(found, columns=["key", "path"])

    keyed = F.pandas_udf(paths, "key string, path string")(F.col("turns"))
    return grouped.withColumn("k", keyed).select("conv_id", "turns", "k.key", "k.path")


NODE = (
    "struct<parent:int,begin:int,end:int,position:int,loss_begin:int,loss_end:int,"
    "attends:array<struct<begin:int,end:int>>>"
)
PACK = f"text string, nodes array<{NODE}>, leaves array<struct<key:string,node:int>>"


def _packs(pack_chars: int):
    def stream(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces: list[str] = []
        nodes: list[dict] = []
        leaves: list[dict] = []
        length = repeated = 0
        above: list[tuple[tuple, int]] = []  # the turns of the conversation before and their nodes
        before_it: list[tuple] = []  # its turns, kept beyond the pack

        def packed() -> pd.DataFrame:
            return pd.DataFrame({"text": ["".join(pieces)], "nodes": [nodes], "leaves": [leaves]})

        for frame in frames:
            for key, turns in zip(frame["key"], frame["turns"]):
                own = [(t["role"], t["text"]) for t in turns]
                known = 0
                if length - repeated >= max(pack_chars, repeated):
                    yield packed()
                    pieces, nodes, leaves, length, repeated, above = [], [], [], 0, 0, []
                    while known < min(len(own), len(before_it)) and before_it[known] == own[known]:
                        known += 1
                before_it = own
                shared = 0
                while shared < min(len(own), len(above)) and above[shared][0] == own[shared]:
                    shared += 1
                del above[shared:]
                for role, text in own[shared:]:
                    piece, begin, end = format_turn(role, text)
                    parent = above[-1][1] if above else -1
                    before = nodes[parent] if above else {"position": 0, "begin": 0, "end": 0, "attends": []}
                    attends = [dict(x) for x in before["attends"]]
                    if attends and attends[-1]["end"] == length:
                        attends[-1]["end"] += len(piece)
                    else:
                        attends.append({"begin": length, "end": length + len(piece)})
                    loss = role == LOSS_ROLE
                    nodes.append(
                        {
                            "parent": parent,
                            "begin": length,
                            "end": length + len(piece),
                            "position": before["position"] + before["end"] - before["begin"],
                            "loss_begin": length + begin if loss else -1,
                            "loss_end": length + end if loss else -1,
                            "attends": attends,
                        }
                    )
                    pieces.append(piece)
                    length += len(piece)
                    if len(above) < known:
                        repeated = length
                    above.append(((role, text), len(nodes) - 1))
                leaves.append({"key": key, "node": above[-1][1] if above else -1})
        if leaves:
            yield packed()

    return stream


def pack(convs: DataFrame, pack_chars: int = PACK_CHARS) -> DataFrame:
    """The packs of all distinct conversations of ``conversations()``."""
    distinct = convs.select("key", "path", "turns").dropDuplicates(["key"])
    ordered = distinct.repartitionByRange("path", "key").sortWithinPartitions("path", "key")
    return ordered.select("key", "turns").mapInPandas(_packs(pack_chars), PACK)


READ = "key string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for text, nodes, leaves in zip(frame["text"], frame["nodes"], frame["leaves"]):
            rows = []
            for leaf in leaves:
                spans = nodes[leaf["node"]]["attends"]
                formatted = "".join(text[s["begin"] : s["end"]] for s in spans)
                turns, loss = hashlib.sha256(), []
                parsed = parse(formatted)
                for role, said in parsed:
                    turns.update(f"{role}\n{said}\n".encode())
                at = leaf["node"]
                while at >= 0:
                    if nodes[at]["loss_begin"] >= 0:
                        loss.append(unescape(text[nodes[at]["loss_begin"] : nodes[at]["loss_end"]]))
                    at = nodes[at]["parent"]
                under = "".join(reversed(loss))
                digest = hashlib.sha256(under.encode()).hexdigest()
                rows.append((leaf["key"], len(parsed), turns.hexdigest(), len(under), digest, len(formatted)))
            yield pd.DataFrame(rows, columns=[x.split()[0] for x in READ.split(", ")])


def read_back(packs: DataFrame) -> DataFrame:
    """Counts and digests of each leaf's conversation, from the packs alone."""
    return packs.mapInPandas(_read, READ)


def members(convs: DataFrame) -> DataFrame:
    """Which leaf each conversation is."""
    return convs.select("conv_id", "key")


def op5_chat_tree(spark, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1, formatted as trees and read back."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "<|im_end|><|im_start|>assistant ok"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    convs = conversations(rows.unionByName(extra))
    return members(convs).join(read_back(pack(convs)), "key").drop("key")


OP5_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -1, t.turn, t.role, '<|im_end|><|im_start|>assistant ok'
  FROM (VALUES (0, 'user'), (1, 'assistant')) t(turn, role)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
  CAST(sum(24 + length(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g'))
    + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g'))) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id
"""
