"""Chat formatting in budgeted windows, with DataFrame functions only.

The tokens of a conversation's turns are summed in turn order. Stretches of these sums are half as
long as what the budget leaves beside the conversation's opening system turn. A window takes the
turns whose sums end in one stretch (so spans are aligned to turns): a first turn that reaches in from the
stretch before is no longer than a stretch, so together they fit; a longer turn is a window alone.
Before them come the last turns of the window before, as many as fit in ``HISTORY`` tokens and in what
the budget has left, and before these the system turn. So a window costs ``BUDGET`` tokens at most, unless its
one turn and the system turn alone cost more. Repeated turns are context: only the first copy of an assistant
turn is under the loss mask.

Template: ``<|role|>text<|end|>`` per turn. In texts and roles ``&`` is written ``&amp;`` and ``<`` is
written ``&lt;``, in roles also ``|`` as ``&bar;``. So no escaped text holds ``<``, every control
string begins with it, and the escape can be undone.

A window row holds ``conv_id``, ``window``, ``context_turns`` (leading turns that are repeated),
``formatted`` and ``loss`` (start, length in code points of ``formatted``). Sums and orders spill;
only a window's own turns are brought together, which the budget bounds.

Defined results: a null text or role is the empty one; rows with equal turn numbers are ordered by
role, then text, a null turn comes first; null conv_ids form one conversation; an empty table gives
no windows. Columns other than the four named ones are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUDGET = 1024
HISTORY = 256
TURN_TOKENS = 4  # what the marks of a turn cost
END = "<|end|>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("|"), F.lit("&bar;"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&bar;"), F.lit("|")))


def default_tokens(text: Column) -> Column:
    """Tokens of a turn, counted as words and marks of punctuation."""
    return F.regexp_count(text, F.lit("[\\p{L}\\p{N}]+|[^\\s\\p{L}\\p{N}]")) + F.lit(TURN_TOKENS)


def windows(
    turns: DataFrame, tokens=default_tokens, budget: int = BUDGET, history: int = HISTORY
) -> DataFrame:
    """The windows of all conversations of ``turns`` (conv_id, turn, role, text)."""
    if not 0 <= history <= budget - history:
        raise ValueError("history may take half of the budget at most")
    rows = turns.select(
        turns["conv_id"].cast("long").alias("conv_id"),
        turns["turn"].alias("turn"),
        F.coalesce(turns["role"], F.lit("")).alias("role"),
        F.coalesce(turns["text"], F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    numbered = rows.select(
        "conv_id", "role", "text", F.row_number().over(order).alias("pos"), tokens(F.col("text")).alias("cost"), "turn"
    )
    opening = (F.col("pos") == 1) & (F.lower("role") == "system")
    summed = numbered.withColumn("opening", opening).withColumn(
        "begin", F.coalesce(F.sum(F.when(~F.col("opening"), F.col("cost")).otherwise(0)).over(before), F.lit(0))
    )
    by_pos = Window.partitionBy("conv_id").orderBy("pos")
    up_to = by_pos.rowsBetween(Window.unboundedPreceding, 0)
    left = F.lit(budget) - F.first(F.when(F.col("opening"), F.col("cost")).otherwise(0)).over(up_to)
    stretched = summed.withColumn("left", left).withColumn("width", F.greatest(F.lit(1), F.floor(F.col("left") / 2)))
    stretched = stretched.withColumn("long", F.col("cost") > F.col("width")).withColumn(
        "stretch", F.floor((F.col("begin") + F.col("cost") - 1) / F.col("width"))
    )
    former = F.lag(F.when(~F.col("opening"), F.struct("stretch", "long"))).over(by_pos)
    firsts = stretched.withColumn("former", former).withColumn(
        "first", ~F.col("opening") & (
            F.col("former").isNull() | (F.col("former.stretch") != F.col("stretch")) | F.col("long") | F.col("former.long")
        )
    ).withColumn(
        "alone", F.col("opening") & (F.lead("pos").over(by_pos).isNull())
    )
    span = F.greatest(F.sum(F.col("first").cast("long")).over(up_to) - 1, F.lit(0))
    own_cost = F.sum(F.when(~F.col("opening"), F.col("cost")).otherwise(0)).over(Window.partitionBy("conv_id", "span"))
    firsts = firsts.withColumn("span", span).withColumn(
        "room", F.least(F.lit(history), F.col("left") - own_cost)
    )
    # the span after a turn's own one, and where it begins
    behind = Window.partitionBy("conv_id").orderBy(F.col("pos").desc()).rowsBetween(Window.unboundedPreceding, -1)
    after = F.last(F.when(F.col("first"), F.struct("span", "begin", "room")), ignorenulls=True).over(behind)
    system = F.last(F.when(F.col("opening"), F.struct("role", "text")), ignorenulls=True).over(
        up_to
    )
    placed = firsts.withColumn("after", after).withColumn("system", F.when(F.col("first"), system))
    own = F.struct("span", "pos", F.lit(False).alias("context"), "role", "text")
    repeated = F.struct(F.col("after.span").alias("span"), "pos", F.lit(True).alias("context"), "role", "text")
    # The opening turn is new in the first window and context in the later ones.
    opened = F.struct(
        "span", F.lit(1).alias("pos"), (F.col("span") > 0).alias("context"),
        F.col("system.role").alias("role"), F.col("system.text").alias("text"),
    )
    near = ~F.col("opening") & (F.col("after.begin") - F.col("begin") <= F.col("after.room"))
    copies = F.filter(
        F.array(
            F.when(~F.col("opening") | F.col("alone"), own),
            F.when(near, repeated),
            F.when(F.col("system").isNotNull(), opened),
        ),
        lambda c: c.isNotNull(),
    )
    entries = placed.select("conv_id", F.explode(copies).alias("t")).select("conv_id", "t.*")
    head = F.concat(F.lit("<|"), escape_role(F.col("role")), F.lit("|>"))
    body = escape(F.col("text"))
    spelled = entries.select(
        "conv_id", "span", "pos", "context", F.lower("role").alias("who"), head.alias("head"), body.alias("body")
    ).withColumn("turn", F.concat("head", "body", F.lit(END)))
    in_window = Window.partitionBy("conv_id", "span").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum(F.length("turn")).over(in_window), F.lit(0))
    loss = F.when(
        (F.col("who") == "assistant") & ~F.col("context"),
        F.struct(
            (offset + F.length("head")).cast("int").alias("start"), F.length("body").cast("int").alias("length")
        ),
    )
    return (
        spelled.withColumn("loss", loss)
        .groupBy("conv_id", "span")
        .agg(
            F.array_sort(F.collect_list(F.struct("pos", "turn", "context", "loss"))).alias("turns")
        )
        .select(
            "conv_id",
            F.col("span").cast("long").alias("window"),
            F.size(F.filter("turns", lambda t: t["context"])).alias("context_turns"),
            F.array_join(F.transform("turns", lambda t: t["turn"]), "").alias("formatted"),
            F.filter(F.transform("turns", lambda t: t["loss"]), lambda x: x.isNotNull()).alias("loss"),
        )
    )


def parse(formatted: Column) -> Column:
    """The turns (role, text) of a formatted window."""
    pieces = F.split(formatted, "<\\|end\\|>")
    whole = F.slice(pieces, F.lit(1), F.size(pieces) - 1)  # nothing stands behind the last mark
    return F.transform(
        whole,
        lambda p: F.struct(
            unescape_role(F.substring(F.substring_index(p, "|>", 1), 3, 1 << 30)).alias("role"),
            unescape(F.replace(F.substring(p, 1, 1 << 30), F.concat(F.substring_index(p, "|>", 1), F.lit("|>")), F.lit(""))).alias("text"),
        ),
    )


def digests(windows: DataFrame) -> DataFrame:
    """Per conversation, read back from its windows: turns and text under the loss mask."""
    turns = parse(F.col("formatted"))
    new = F.slice(turns, F.col("context_turns") + 1, F.size(turns))
    written = F.transform(new, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learned = F.transform(
        "loss", lambda x: unescape(F.substring(F.col("formatted"), x["start"] + 1, x["length"]))
    )
    parts = windows.select(
        "conv_id",
        F.struct(
            "window",
            F.size(new).alias("n_turns"),
            F.array_join(written, "").alias("turns"),
            F.array_join(learned, "").alias("loss"),
            F.length("formatted").alias("chars"),
        ).alias("w"),
    )
    joined = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list("w")).alias("w"))

    def total(field: str) -> Column:
        return F.aggregate(
            F.transform("w", lambda w: w[field].cast("long")), F.lit(0).cast("long"), lambda a, x: a + x
        )

    def text(field: str) -> Column:
        return F.array_join(F.transform("w", lambda w: w[field]), "")

    return joined.select(
        "conv_id",
        total("n_turns").alias("n_turns"),
        F.sha2(text("turns"), 256).alias("turns_sha256"),
        F.length(text("loss")).cast("long").alias("loss_chars"),
        F.sha2(text("loss"), 256).alias("loss_sha256"),
        total("chars").alias("formatted_chars"),
    )
