"""Chat formatting whose output a deterministic parser turns back into the turns it came from.

Grammar (the strings are parameters of ``Template``)::

    conversation = { turn }
    turn         = open role sep text close
    open "[INST:"  sep "] "  close " [/INST]</s>"      (defaults)

``render`` writes a turn as it is, ``parse`` reads the result back, and a turn whose recovered form
differs from its source is written again with its control strings escaped, until source and
reading are identical. Escaping puts ``\\`` after the first character of anything that looks like a
control string; a control string that carries n backslashes gets n + 1, so unescaping (always
done by the parser) takes exactly one away and any text survives.

Defined results: null text is empty, null role is the role ``""``; turns sort by turn number (nulls
first), then role, then text; repeated rows are repeated turns; rows with a null conv_id form one
conversation; an empty table gives no rows; other columns are left out. A conversation is one
output row, so it must fit into a task, as any text that a model reads must.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.workers import map_arrow


@dataclass(frozen=True)
class Template:
    open: str = "[INST:"
    sep: str = "] "
    close: str = " [/INST]</s>"
    #: Strings that a tokenizer maps to control tokens; they are escaped inside texts too.
    controls: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "[INST:", "<<SYS>>", "<</SYS>>", "<|")
    loss_roles: tuple[str, ...] = ("assistant",)


class Formatter:
    def __init__(self, template: Template):
        self.t = template
        # Only the first character and the backslashes are consumed, so that overlapping strings are each seen.
        tails = "|".join(re.escape(c[1:]) for c in dict.fromkeys((*template.controls, template.open.strip(), template.close.strip())))
        heads = "".join(re.escape(c[0]) for c in dict.fromkeys(c[0] for c in (*template.controls, template.open.strip(), template.close.strip())))
        self._mark = re.compile(rf"([{heads}])(\\*)(?={tails})")
        self._role_mark = re.compile(r"([\]\\])")

    def escape(self, text: str) -> str:
        return self._mark.sub(r"\1\\\2", text)

    def unescape(self, text: str) -> str:
        return self._mark.sub(lambda m: m[1] + m[2][1:], text)

    def render(self, turns: list[tuple[str, str]], escaped: list[bool]) -> tuple[str, list[tuple[int, int]]]:
        """The text and the loss spans in it (start, stop) of the turns in ``loss_roles``."""
        out, spans, at = [], [], 0
        for (role, text), esc in zip(turns, escaped):
            body = self.escape(text) if esc else text
            head = self.t.open + self._role_mark.sub(r"\\\1", role) + self.t.sep
            if role in self.t.loss_roles:
                spans.append((at + len(head), at + len(head) + len(body)))
            out += (head, body, self.t.close)
            at += len(head) + len(body) + len(self.t.close)
        return "".join(out), spans

    def parse(self, formatted: str) -> list[tuple[str, str]]:
        """The turns of a rendered text; each turn ends at the first ``close``."""
        turns, at = [], 0
        while at < len(formatted):
            if not formatted.startswith(self.t.open, at):
                raise ValueError(f"no turn at {at}")
            at += len(self.t.open)
            role = []
            while not formatted.startswith(self.t.sep, at):
                at += formatted[at] == "\\"
                if at >= len(formatted):
                    raise ValueError("a role without end")
                role.append(formatted[at])
                at += 1
            at += len(self.t.sep)
            stop = formatted.find(self.t.close, at)
            if stop < 0:
                raise ValueError("a turn without end")
            turns.append(("".join(role), self.unescape(formatted[at:stop])))
            at = stop + len(self.t.close)
        return turns

    def _reads_back(self, turn: tuple[str, str], escaped: bool) -> bool:
        try:
            return self.parse(self.render([turn], [escaped])[0]) == [turn]
        except ValueError:
            return False

    def round_trip(self, turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]], list[bool]]:
        """Render, reparse and escape what conflicts until the recovered turns equal the source.

        Content conflicts where its turn doesn't read back, or where it holds a control string.
        """
        escaped = [self._mark.search(text) is not None for _, text in turns]
        while True:
            formatted, spans = self.render(turns, escaped)
            try:
                if self.parse(formatted) == turns:
                    return formatted, spans, escaped
            except ValueError:
                pass
            wrong = [not e and not self._reads_back(t, False) for t, e in zip(turns, escaped)]
            if not any(wrong):
                raise ValueError("the template is ambiguous even with everything escaped")
            escaped = [e or w for e, w in zip(escaped, wrong)]

    def loss_text(self, formatted: str, spans: list[tuple[int, int]]) -> str:
        return "".join(self.unescape(formatted[a:b]) for a, b in spans)


def format_conversations(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """conv_id, formatted, spans (start and stop of loss, in code points), n_escaped for each conversation."""
    part = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(part)).alias("turns"))
    form = Formatter(template)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [form.round_trip([(t["role"], t["text"]) for t in row]) for row in batch.column("turns").to_pylist()]
            spans = pa.array([[{"start": a, "stop": b} for a, b in x[1]] for x in found], pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))
            yield pa.record_batch([batch.column("conv_id"), pa.array([x[0] for x in found], pa.string()), spans, pa.array([sum(x[2]) for x in found], pa.int64())], names=["conv_id", "formatted", "spans", "n_escaped"])

    return map_arrow(grouped, run, "conv_id long, formatted string, spans array<struct<start: long, stop: long>>, n_escaped long")


def read_back(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """conv_id, turns (role and text), loss_text, recovered from the output of ``format_conversations``."""
    form = Formatter(template)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("formatted").to_pylist()
            turns = [[{"role": r, "text": t} for r, t in form.parse(x)] for x in texts]
            loss = [form.loss_text(x, [(s["start"], s["stop"]) for s in spans]) for x, spans in zip(texts, batch.column("spans").to_pylist())]
            kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
            yield pa.record_batch([batch.column("conv_id"), batch.column("formatted"), pa.array(turns, kind), pa.array(loss, pa.string())], names=["conv_id", "formatted", "turns", "loss_text"])

    return map_arrow(formatted.select("conv_id", "formatted", "spans"), run, "conv_id long, formatted string, turns array<struct<role: string, text: string>>, loss_text string")


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    back = read_back(format_conversations(table.unionByName(extra)))
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(joined, 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )
