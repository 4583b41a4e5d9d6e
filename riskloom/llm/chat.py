"""Chat formatting (operator 13): typed content parts flattened into a marked, reversible text.

A message's content is a list of typed parts.  A visitor (one expression
with a branch for each kind) turns them, in order, into text: a text part
into its escaped text, an image, audio or document part into a placeholder.
Each placeholder leaves an attachment record, in order: its turn, part, kind,
reference and the tokens it will expand to, worked out from its size.

Template: ``<s>``, then for each turn ``[INST]role[/INST]content</s>``.

Escaping: a control string in a text gets a ``~`` after its first
character, and one more if it has some already (``</s>`` to ``<~/s>``,
``<~/s>`` to ``<~~/s>``).  So no text holds a control string, and taking
one ``~`` away restores it.  A control string is never made where text and
template meet, as each begins with ``<`` or ``[`` and has neither inside.

The loss mask is kept by turn: the turn's length and which of its
characters (code points) are trained on, the content of assistant turns.
The formatted text is written; ``read_back`` splits what it reads at the
control strings and takes the masked characters by the mask alone.

Built-in functions only; a row is formatted on its own, and one shuffle
brings a conversation's turns together.  A conversation is one value, its
text and digest, so its turns meet in one row whatever their number; all
work on it is linear in its length.

Defined results: null text, role or list of parts is empty; a part of an
unknown or null kind is read as text; an attachment without a size expands
to one token; turns stand by number, null first, and equal numbers by their
formatted text; repeated rows are turns of their own; null ids are one
conversation; an empty table gives an empty table; only the named columns
are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import materialize

PROBE = "</s>[INST] ok [/INST]"
BEGIN, HEAD, HEAD_END, END = "<s>", "[INST]", "[/INST]", "</s>"
PLACEHOLDERS = {"image": "[IMG]", "audio": "[AUDIO]", "document": "[DOC]"}
TRAINED = "assistant"
#: Tokens of an attachment: image patches of so many pixels a side, audio frames a second, tokens a document page.
PATCH, FRAMES, PAGE = 28, 12.5, 512
PART = "struct<kind:string,text:string,ref:string,width:bigint,height:bigint,seconds:double,pages:bigint>"
_CONTROL = (r"/?s>", r"(?:/?INST|IMG|AUDIO|DOC)\]")


def escape(text: Column) -> Column:
    """``text`` without control strings."""
    text = F.regexp_replace(text, rf"<(~*{_CONTROL[0]})", r"<~$1")
    return F.regexp_replace(text, rf"\[(~*{_CONTROL[1]})", r"[~$1")


def unescape(text: Column) -> Column:
    """The text that ``escape`` was given."""
    text = F.regexp_replace(text, rf"<~(~*{_CONTROL[0]})", r"<$1")
    return F.regexp_replace(text, rf"\[~(~*{_CONTROL[1]})", r"[$1")


def _plain(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def visit(part: Column) -> Column:
    """One part as text: escaped, or its placeholder."""
    out = None
    for kind, mark in PLACEHOLDERS.items():
        out = F.when(part["kind"] == kind, F.lit(mark)) if out is None else out.when(part["kind"] == kind, F.lit(mark))
    return out.otherwise(escape(_plain(part["text"])))


def expanded_tokens(part: Column) -> Column:
    """Tokens that an attachment's placeholder expands to; one if its size is not known."""
    patches = F.ceil(part["width"] / PATCH) * F.ceil(part["height"] / PATCH)
    n = F.when(part["kind"] == "image", patches).when(part["kind"] == "audio", F.ceil(part["seconds"] * FRAMES)).otherwise(part["pages"] * PAGE)
    return F.greatest(F.lit(1), F.coalesce(n, F.lit(1))).cast("long")


def format_turns(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", parts_col: str = "parts") -> DataFrame:
    """(conv_id, turn, formatted, loss_from, loss_chars, found): every message on its own, without a shuffle."""
    role, parts = _plain(F.col(role_col)), F.coalesce(F.col(parts_col).cast(f"array<{PART}>"), F.array().cast(f"array<{PART}>"))
    rows = messages.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"), parts.alias("parts"))
    content = F.array_join(F.transform("parts", visit), "")
    rows = rows.select("conv_id", "turn", "role", "parts", F.concat(F.lit(HEAD), escape(F.col("role")), F.lit(HEAD_END)).alias("head"), content.alias("content"))
    held = F.transform("parts", lambda p, i: F.struct(i.cast("int").alias("part"), p["kind"].alias("kind"), p["ref"].alias("ref"), expanded_tokens(p).alias("tokens")))
    trained = F.col("role") == TRAINED
    return rows.select(
        "conv_id", "turn", F.concat("head", "content", F.lit(END)).alias("formatted"),
        F.char_length("head").alias("loss_from"), F.when(trained, F.char_length("content")).otherwise(0).alias("loss_chars"),
        F.filter(held, lambda a: a["kind"].isin(*PLACEHOLDERS)).alias("found"),
    )


def format_conversations(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", parts_col: str = "parts") -> DataFrame:
    """(conv_id, formatted, mask, attachments, expanded_tokens) of every conversation.

    ``mask``: for each turn its length, where its trained characters begin
    and how many there are.
    """
    rows = format_turns(messages, conv_col, turn_col, role_col, parts_col)
    one = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "formatted", "loss_from", "loss_chars", "found"))).alias("turns"))
    mask = F.transform("turns", lambda t: F.struct(F.char_length(t["formatted"]).alias("chars"), t["loss_from"].alias("loss_from"), t["loss_chars"].alias("loss_chars")))
    marked = F.transform("turns", lambda t, i: F.transform(t["found"], lambda a: F.struct(i.cast("int").alias("turn"), a["part"].alias("part"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens"))))
    one = one.select("conv_id", F.concat(F.lit(BEGIN), F.array_join(F.transform("turns", lambda t: t["formatted"]), "")).alias("formatted"), mask.alias("mask"), F.flatten(marked).alias("attachments"))
    return one.withColumn("expanded_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"]))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, roles, contents, loss): the turns of a formatted text, and the text under its mask by turn."""
    body = F.substring(F.col("formatted"), len(BEGIN) + 1, 2**31 - 1)
    pieces = F.split(body, END, -1)  # the last is what stands after the last turn: nothing
    rows = formatted.withColumn("pieces", F.slice(pieces, 1, F.size(pieces) - 1))
    sizes = F.transform("pieces", lambda p: F.char_length(p) + len(END))
    right = F.col("formatted").startswith(BEGIN) & (sizes == F.transform("mask", lambda m: m["chars"]))
    rows = rows.withColumn("pieces", F.when(right, F.col("pieces")).otherwise(F.raise_error(F.lit("the mask does not fit the text")).cast("array<string>")))
    part = lambda p, i: F.element_at(F.split(p, r"\[/INST\]", 2), i)
    loss = F.transform(F.arrays_zip("pieces", "mask"), lambda z: unescape(z["pieces"].substr(z["mask"]["loss_from"] + 1, z["mask"]["loss_chars"])))
    return rows.select(
        "conv_id",
        F.transform("pieces", lambda p: unescape(F.substring(part(p, 1), len(HEAD) + 1, 2**31 - 1))).alias("roles"),
        F.transform("pieces", lambda p: unescape(part(p, 2))).alias("contents"),
        loss.alias("loss"), "formatted",
    )


def report(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Digests of what the formatted conversations say, each row a turn with one text part."""
    null = lambda kind: F.lit(None).cast(kind)
    part = F.struct(F.lit("text").alias("kind"), F.col(text_col).cast("string").alias("text"), null("string").alias("ref"), null("long").alias("width"), null("long").alias("height"), null("double").alias("seconds"), null("long").alias("pages"))
    messages = rows.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.array(part).alias("parts"))
    back = read_back(materialize(format_conversations(messages), "chat-formatted"))
    turns = F.array_join(F.transform(F.arrays_zip("roles", "contents"), lambda z: F.concat(z["roles"], F.lit("\n"), z["contents"], F.lit("\n"))), "")
    back = back.select("conv_id", F.size("roles").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"), F.array_join("loss", "").alias("loss"), F.char_length("formatted").cast("long").alias("formatted_chars"))
    return back.select("conv_id", "n_turns", "turns_sha256", F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
