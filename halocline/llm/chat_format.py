r"""Chat formatting: turns become token ids of a template, with the mask of the tokens that are learned.

Token-level assembly.  The turns are dealt by range of (conv_id, turn, role, text), so a conversation of any size
lies in order over as many tasks as it needs.  There each content is encoded on its own, as ordinary text; the ids
that the template reserves for its control strings are spliced in between, and prefix sums over the segments' lengths
give every turn its first token's place in the conversation and the loss mask.  Places of conversations that go on in
another task are moved by the tokens before them; at most one conversation goes on in each task, so that table has no
more rows than there are tasks.

A control string inside a content never becomes a reserved id.  So that the formatted text can be read back as well,
it is escaped: a backslash goes in after its first character, also where backslashes stand there already;
``[INST]`` becomes ``[\INST]``, and ``[\INST]`` becomes ``[\\INST]``.  Reading takes one backslash away.

Edge cases: a null role or text is an empty one; roles unknown to the template are written out after a control of
their own, so that they come back; a null ``conv_id`` is a conversation of its own; turns are ordered by (turn, role,
text), nulls first, and repeated rows are repeated turns; further columns are ignored; an empty table gives no rows.
Texts are encoded whole; in white space of over 100,000 characters the encoder starts afresh at every 100,000th.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from halocline.llm.common import materialize, read_table, small_batches

LONG_SPACE = re.compile(r"(\s{100000})")
ESCAPE = "\\"


@dataclass(frozen=True)
class Template:
    """Control strings: what opens and closes a turn of a role, and what marks role, text and end of any other."""

    roles: dict[str, tuple[str, str]] = field(default_factory=lambda: {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")})
    other: tuple[str, str, str] = ("<|role|>", "<|text|>", "<|end|>")
    learned: str = "assistant"

    @property
    def controls(self) -> list[str]:
        """All control strings, in the order of their reserved ids."""
        return [c for pair in self.roles.values() for c in pair] + list(self.other)

    def pattern(self, backslashes: str) -> re.Pattern[str]:
        """The first character of a control string, where ``backslashes`` and the rest of it follow."""
        rests: dict[str, list[str]] = {}
        for c in self.controls:
            rests.setdefault(c[0], []).append(re.escape(c[1:]))
        return re.compile("|".join(rf"{re.escape(head)}(?={backslashes}(?:{'|'.join(rest)}))" for head, rest in rests.items()))

    def counted_sql(self) -> str:
        """The same as one expression without look-ahead, for other engines."""
        return "|".join(rf"{re.escape(c[0])}\\*{re.escape(c[1:])}" for c in self.controls)


TEMPLATE = Template()


class Escaper:
    def __init__(self, template: Template) -> None:
        self.plain, self.marked = template.pattern(r"\\*"), template.pattern(r"\\+")

    def escape(self, text: str) -> str:
        return self.plain.sub(lambda m: m[0] + ESCAPE, text)

    def unescape(self, text: str) -> str:
        out, done = [], 0
        for m in self.marked.finditer(text):
            out.append(text[done : m.end()])
            done = m.end() + 1
        return "".join([*out, text[done:]])


class Codec:
    """Ids of contents and back; reserved ids follow the vocabulary's own."""

    def __init__(self, template: Template, vocabulary: str) -> None:
        import public_tokenizers
        import tiktoken

        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("chat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.escaper, self.template = Escaper(template), template
        self.first = max(ranks.values()) + 2  # one id is left to the end of a text
        self.reserved = {c: self.first + k for k, c in enumerate(template.controls)}
        self.strings = {k: c for c, k in self.reserved.items()}

    def ids(self, content: str) -> np.ndarray:
        pieces = LONG_SPACE.split(self.escaper.escape(content)) if len(content) > 100_000 else [self.escaper.escape(content)]
        found = [self.encoding.encode_to_numpy(p, disallowed_special=()).astype(np.int32) for p in pieces if p]
        return np.concatenate(found) if len(found) != 1 else found[0]

    def text(self, ids: np.ndarray) -> str:
        """Of ids without reserved ones, as it stands in the formatted text."""
        return self.encoding.decode_bytes(ids.tolist()).decode("utf-8")

    def turn(self, role: str, text: str) -> list[np.ndarray]:
        """Five segments: opening, role, text's mark, text, closing; role and mark are empty for the template's roles."""
        none = np.zeros(0, np.int32)
        mark = lambda c: np.array([self.reserved[c]], np.int32)
        if role in self.template.roles:
            opening, closing = self.template.roles[role]
            return [mark(opening), none, none, self.ids(text) if text else none, mark(closing)]
        opening, middle, closing = self.template.other
        return [mark(opening), self.ids(role) if role else none, mark(middle), self.ids(text) if text else none, mark(closing)]

    def read(self, ids: np.ndarray) -> tuple[str, str, int]:
        """(role, text, characters of the formatted text) of one turn's ids."""
        marks = np.flatnonzero(ids >= self.first)
        controls = [self.strings[int(i)] for i in ids[marks]]
        parts = [self.text(ids[a + 1 : b]) for a, b in zip(marks, marks[1:], strict=False)]
        chars = sum(map(len, controls)) + sum(map(len, parts))
        known = {pair: role for role, pair in self.template.roles.items()}
        if tuple(controls) in known:
            return known[tuple(controls)], self.escaper.unescape(parts[0]), chars
        if tuple(controls) != self.template.other:
            raise ValueError(f"not a turn of the template: {controls}")
        return self.escaper.unescape(parts[0]), self.escaper.unescape(parts[1]), chars


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


# ---------------------------------------------------------------- the operator


def format_conversations(convs: DataFrame, template: Template = TEMPLATE, vocabulary: str | None = None) -> DataFrame:
    """A row per turn: conv_id, turn, (part, place) in order, its ids, loss mask, and token_start in the conversation."""
    vocabulary = vocabulary or default_vocabulary()
    empty = F.lit("")
    turns = convs.select("conv_id", "turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    dealt = turns.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 16)).sortWithinPartitions("conv_id", "turn", "role", "text")
    kind = {f.name: f.dataType.simpleString() for f in turns.schema}
    schema = f"conv_id {kind['conv_id']}, turn {kind['turn']}, part int, place long, ids array<int>, loss array<boolean>, token_start long"

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, part = Codec(template, vocabulary), TaskContext.get().partitionId()
        place, before, last = 0, 0, object()  # tokens of the conversation so far, and which that is
        for batch in small_batches(batches, 3):
            roles = batch.column(2).to_pylist()
            segments = [s for role, text in zip(roles, batch.column(3).to_pylist(), strict=True) for s in codec.turn(role, text)]
            lens = np.array([len(s) for s in segments], np.int64)
            ends = np.cumsum(lens).reshape(-1, 5)
            starts = ends - lens.reshape(-1, 5)
            # the mask: +1 where a learned text begins, -1 where it ends, summed up
            learned = np.array([role == template.learned for role in roles])
            steps = np.zeros(ends[-1, -1] + 1, np.int64)
            np.add.at(steps, starts[learned, 3], 1)
            np.add.at(steps, ends[learned, 3], -1)
            mask = np.cumsum(steps)[:-1] > 0
            # a turn's first token, counted from that of its conversation in this task
            first = np.zeros(batch.num_rows, np.int64)
            base = -before
            for k, conv in enumerate(batch.column(0).to_pylist()):
                if conv != last:
                    base, last = starts[k, 0], conv
                first[k] = starts[k, 0] - base
            before = ends[-1, -1] - base
            offsets = pa.array(np.append(starts[:, 0], ends[-1, -1]).astype(np.int32))
            n = batch.num_rows
            columns = [batch.column(0), batch.column(1), pa.array(np.full(n, part, np.int32)), pa.array(np.arange(place, place + n))]
            columns += [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(segments))), pa.ListArray.from_arrays(offsets, pa.array(mask)), pa.array(first)]
            yield pa.RecordBatch.from_arrays(columns, ["conv_id", "turn", "part", "place", "ids", "loss", "token_start"])
            place += n

    local = materialize(dealt.mapInArrow(assemble, schema))
    moved = F.broadcast(shifts(local)).withColumnsRenamed({"conv_id": "conv_id_", "part": "part_"})
    out = local.join(moved, (F.col("part") == F.col("part_")) & F.col("conv_id").eqNullSafe(F.col("conv_id_")), "left")
    return out.select("conv_id", "turn", "part", "place", "ids", "loss", (F.col("token_start") + F.coalesce("shift", F.lit(0))).alias("token_start"))


def shifts(local: DataFrame) -> DataFrame:
    """(conv_id, part, shift): the tokens in earlier tasks of conversations that go on, at most one for each task.

    Rows lie in order, so such a conversation is the first or last of its tasks.
    """
    ends = local.groupBy("part").agg(F.min(F.struct("conv_id")).alias("a"), F.max(F.struct("conv_id")).alias("b"))
    edges = ends.select(F.explode(F.array("a", "b")).alias("e")).select(F.col("e.conv_id").alias("edge")).distinct()
    sizes = local.select("conv_id", "part", F.size("ids").alias("n")).join(F.broadcast(edges), F.col("conv_id").eqNullSafe(F.col("edge")), "left_semi")
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.groupBy("conv_id", "part").agg(F.sum("n").alias("n")).select("conv_id", "part", F.sum("n").over(earlier).alias("shift")).where("shift IS NOT NULL")


def read_back(formatted: DataFrame, template: Template = TEMPLATE, vocabulary: str | None = None) -> DataFrame:
    """Roles, texts and texts under the mask from ids and masks alone, a row per turn."""
    vocabulary = vocabulary or default_vocabulary()
    kind = formatted.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(template, vocabulary)
        for batch in batches:
            if not batch.num_rows:
                continue
            at = np.array(batch.column(3).offsets)
            ids, mask = np.array(batch.column(3).values), np.array(batch.column(4).values)
            turns = [codec.read(ids[a:b]) for a, b in zip(at, at[1:], strict=False)]
            learned = [codec.escaper.unescape(codec.text(ids[a:b][mask[a:b]])) for a, b in zip(at, at[1:], strict=False)]
            role, text, chars = zip(*turns, strict=True)
            columns = [*batch.columns[:3], pa.array(role, pa.string()), pa.array(text, pa.string()), pa.array(learned, pa.string()), pa.array(chars, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["conv_id", "part", "place", "role", "text", "learned", "chars"])

    schema = f"conv_id {kind}, part int, place long, role string, text string, learned string, chars long"
    return formatted.select("conv_id", "part", "place", "ids", "loss").mapInArrow(run, schema)


def digests(turns: DataFrame) -> DataFrame:
    """A row per conversation of read_back's turns.

    SHA-256 of a conversation takes its texts one after the other: they stream through one task in order, held a batch
    at a time.  All other work on a conversation is split.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = None, None

        def done() -> list:
            n, turns_sha, loss, loss_sha, chars = state
            return [conv, n, turns_sha.hexdigest(), loss, loss_sha.hexdigest(), chars]

        for batch in batches:
            out = []
            for c, role, text, learned, chars in zip(*(batch.column(k).to_pylist() for k in (0, 3, 4, 5, 6)), strict=True):
                if state is None or c != conv:
                    out += [done()] if state else []
                    conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[2] += len(learned)
                state[3].update(learned.encode())
                state[4] += chars
            yield rows(out, batch.schema.field(0).type)
        if state:
            yield rows([done()], batch.schema.field(0).type)

    def rows(found: list[list], conv_type: pa.DataType) -> pa.RecordBatch:
        kinds = [conv_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in found], t) for k, t in enumerate(kinds)], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", "part", "place").mapInArrow(fold, schema)


CONTROLS_IN_TEXT = "</s>[INST] ok [/INST]"


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(-7, 0, "user", CONTROLS_IN_TEXT), (-7, 1, "assistant", CONTROLS_IN_TEXT)], convs.schema)
    return digests(read_back(format_conversations(convs.unionByName(added))))


ORACLE_SQL = {
    "op11_chat_format": rf"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '{CONTROLS_IN_TEXT}' UNION ALL SELECT -7, 1, 'assistant', '{CONTROLS_IN_TEXT}'),
marked AS (
    SELECT *, length(text) + len(regexp_extract_all(text, '{TEMPLATE.counted_sql()}'))
              + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
                ELSE 23 + length(role) + len(regexp_extract_all(role, '{TEMPLATE.counted_sql()}')) END AS chars
    FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id""",
}
