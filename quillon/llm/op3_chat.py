"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it as context,
its text as the only trainable span. A conversation that does not end in an assistant
turn gets one more example, without a trainable span, so that no turn is lost.

Template: ``[INST] <<SYS>>role<</SYS>> text [/INST]`` for a turn of any other role,
``<s>text</s>`` for an assistant turn, nothing between turns. Control strings inside
roles and texts are escaped reversibly: a backslash is doubled, and each of the six
control strings gets a backslash after its first character; so none of them is left in
a text, and reading takes each backslash as "the next character as it is".

Rows of a conversation are dealt by conv_id, sorted by turn, and streamed: a task
holds one formatted prefix, not the rows of a group. An example holds its whole
context, so the longest conversation must fit a task, and the formatted text of a
conversation grows with the square of its turns, as the method has it.

Defined results: a null text or role counts as empty; rows with null conv_id are one
conversation (conv_id null). Turns are ordered by turn (null first), then role and
text; repeated rows are turns of their own. Only the role ``assistant``, exactly, is
trainable; an empty assistant text gives an example with an empty span. Empty table: no
rows. Other columns are not looked at.
"""

from __future__ import annotations

import re
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm.common import table

CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
TRAINABLE = "assistant"
_ESCAPE = re.compile("|".join(map(re.escape, ("\\", *CONTROL))))
_TURN = re.compile(r"\[INST\] <<SYS>>(.*?)<</SYS>> (.*?) \[/INST\]|<s>(.*?)</s>", re.S)
EXAMPLES = "conv_id long, example long, text string, loss_start long, loss_end long"
_FLUSH = 8_000_000


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


def formatted_turn(role: str, text: str) -> str:
    if role == TRAINABLE:
        return f"<s>{escape(text)}</s>"
    return f"[INST] <<SYS>>{escape(role)}<</SYS>> {escape(text)} [/INST]"


def parse(text: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a formatted text."""
    out, at = [], 0
    for m in _TURN.finditer(text):
        if m.start() != at:
            raise ValueError(f"no turn begins at {at}")
        out.append((TRAINABLE, unescape(m[3])) if m[3] is not None else (unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(text):
        raise ValueError(f"no turn begins at {at}")
    return out


def _format_batches(batches):
    rows: list[tuple] = []
    held, conv, prefix, n, tail, begun = 0, None, "", 0, False, False

    def flush():
        cols = list(zip(*rows)) if rows else [[]] * 5
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["conv_id", "example", "text", "loss_start", "loss_end"])

    for batch in batches:
        for c, role, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if not begun or c != conv:
                if tail:
                    rows.append((conv, n, prefix, len(prefix), len(prefix)))
                    held += len(prefix)
                conv, prefix, n, tail, begun = c, "", 0, False, True
            role, text = role or "", text or ""
            if role == TRAINABLE:
                start = len(prefix) + len("<s>")
                prefix += formatted_turn(role, text)
                rows.append((conv, n, prefix, start, len(prefix) - len("</s>")))
                n, tail = n + 1, False
                held += len(prefix)
            else:
                prefix += formatted_turn(role, text)
                tail = True
            if held > _FLUSH:
                yield flush()
                rows, held = [], 0
    if tail:
        rows.append((conv, n, prefix, len(prefix), len(prefix)))
    yield flush()


def format_examples(conversations: DataFrame) -> DataFrame:
    """(conv_id, example, text, loss_start, loss_end): examples of a conversation stand together, in order.

    The span is in code points of the formatted text, without the marks around it; it is
    empty (at the end of the text) in an example that has nothing to train on.
    """
    c = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"), F.col("turn").cast("long").alias("turn"))
    c = c.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return c.select("conv_id", "role", "text").mapInArrow(_format_batches, EXAMPLES)


def _read_batches(batches):
    """What stands in the examples of each conversation, read back from their texts and spans."""
    out, conv, begun = [], None, False
    state: dict = {}

    def close():
        turns = parse(state["last"])
        h = sha256()
        for role, text in turns:
            h.update(f"{role}\n{text}\n".encode())
        out.append((conv, len(turns), h.hexdigest(), state["loss_chars"], state["loss"].hexdigest(), state["chars"], state["examples"]))

    def flush():
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        cols = list(zip(*out)) if out else [[]] * 7
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_examples"])

    for batch in batches:
        for c, text, lo, hi in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3, 4))):
            if not begun or c != conv:
                if begun:
                    close()
                conv, begun = c, True
                state = {"loss": sha256(), "loss_chars": 0, "chars": 0, "examples": 0}
            loss = unescape(text[lo:hi])
            state["loss"].update(loss.encode())
            state["loss_chars"] += len(loss)
            state["chars"] += len(text)
            state["examples"] += 1
            state["last"] = text
        if len(out) > 5000:
            yield flush()
            out = []
    if begun:
        close()
    yield flush()


def read_back(examples: DataFrame) -> DataFrame:
    """Digests of each conversation, from the output of ``format_examples`` (whose order it relies on)."""
    return examples.mapInArrow(_read_batches, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_examples long")


def op3_chat_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, whose two texts hold control strings."""
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    all_ = table(spark, sf_dir, "conversations").selectExpr("cast(conv_id as long) conv_id", "cast(turn as long) turn", "role", "text").unionByName(more)
    return read_back(format_examples(all_))


def _esc(column: str) -> str:
    out = f"replace({column}, '\\', '\\\\')"
    for c in CONTROL:
        out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
    return out


#: formatted_chars: every example holds all turns up to its own.
ORACLE = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, coalesce(role, '') = '{TRAINABLE}' AS reply FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]', false UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]', true
), t AS (
  SELECT *, length(CASE WHEN reply THEN '<s>' || {_esc('text')} || '</s>'
    ELSE '[INST] <<SYS>>' || {_esc('role')} || '<</SYS>> ' || {_esc('text')} || ' [/INST]' END) AS n FROM c
), u AS (
  SELECT *, sum(n) OVER w AS upto, lead(conv_id) OVER w IS NULL AS ends FROM t
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE reply), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE reply), '')) AS loss_sha256,
  CAST(sum(upto) FILTER (WHERE reply OR ends) AS BIGINT) AS formatted_chars,
  count(*) FILTER (WHERE reply OR ends) AS n_examples
FROM u GROUP BY conv_id
"""
