"""Chat formatting with Spark expressions only: no Python runs on the executors.

The template writes one block per run of turns of the same role:

    <|im_start|>ROLE\\nTEXT<|im_sep|>TEXT<|im_end|>\\n

Control strings are `<|name|>`. Inside roles and texts every backslash becomes
`\\\\\\\\` and every `<|` becomes `<\\\\|`, so that no text can hold one; reading
back reverses both.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"


def escape(x: Column) -> Column:
    return F.replace(F.replace(x, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def escape_role(x: Column) -> Column:
    return F.replace(escape(x), F.lit("\n"), F.lit("\\n"))


def unescape(x: Column) -> Column:
    """Reverse of escape: pieces between doubled backslashes are mended apart, so that an escaped backslash before `|` stays."""
    return pieces(x, lambda p: F.replace(p, F.lit("<\\|"), F.lit("<|")))


def unescape_role(x: Column) -> Column:
    return pieces(x, lambda p: F.replace(F.replace(p, F.lit("<\\|"), F.lit("<|")), F.lit("\\n"), F.lit("\n")))


def pieces(x: Column, mend: Callable[[Column], Column]) -> Column:
    return F.array_join(F.transform(F.split(x, r"\\\\", -1), mend), "\\")


def format_chats(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: (conv, formatted, mask).

    Rows are turns, ordered by turn, then role, then text; a null turn comes
    first. Repeated rows stay repeated turns. A null role or text counts as empty.
    Rows with a null conversation id form one conversation. Adjacent turns of one
    role become one block whose parts stay apart. An empty table gives no rows;
    further columns are ignored.

    mask is an array of (start, length) in code points of `formatted`, from 0:
    the escaped texts of loss_roles, and nothing else.
    A conversation's string is its result, so one row must hold it. Places in it are
    running sums over its sorted turns, in a window that shares the aggregate's one
    exchange, so that time grows with the number of turns and not with its square.
    """
    kept = F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    rows = df.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), *kept)
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    rows = rows.select("conv", "role", F.lag("role").over(order).alias("last"), F.row_number().over(order).alias("n"), escape_role(F.col("role")).alias("r"), escape(F.col("text")).alias("x"))
    # a turn opens a block unless the turn before it has its role
    opens = F.concat(F.when(F.col("last").isNotNull(), F.lit(END + "\n")).otherwise(F.lit("")), F.lit(START), F.col("r"), F.lit("\n"))
    rows = rows.select("conv", "n", F.col("role").isin(*loss_roles).alias("loss"), F.when(F.col("last") == F.col("role"), F.lit(SEP)).otherwise(opens).alias("before"), "x")
    end = F.sum(F.length("before") + F.length("x")).over(Window.partitionBy("conv").orderBy("n"))
    under = F.when(F.col("loss"), F.struct((end - F.length("x")).cast("long").alias("start"), F.length("x").cast("long").alias("length")))
    rows = rows.select("conv", F.struct("n", F.concat("before", "x").alias("piece"), under.alias("under")).alias("t"))
    turns = rows.groupBy("conv").agg(F.array_sort(F.collect_list("t")).alias("p"))
    return turns.select(
        F.col("conv").alias(conv),
        F.concat(F.array_join(F.transform("p", lambda t: t["piece"]), ""), F.lit(END + "\n")).alias("formatted"),
        F.filter(F.transform("p", lambda t: t["under"]), lambda m: m.isNotNull()).alias("mask"),
    )


def read_back(df: DataFrame, conv: str = "conv_id") -> DataFrame:
    """(conv, turns, loss, formatted): the turns parsed from `formatted`, and the unescaped texts under `mask`."""

    def parsed(block: Column) -> Column:
        rest = F.substr(block, F.lit(len(START) + 1))
        name = F.substring_index(rest, "\n", 1)
        body = F.substr(rest, F.length(name) + 2)
        return F.transform(F.split(body, r"<\|im_sep\|>", -1), lambda x: F.struct(unescape_role(name).alias("role"), unescape(x).alias("text")))

    blocks = F.filter(F.split("formatted", r"<\|im_end\|>\n", -1), lambda b: b != "")
    # in four bytes for each code point any place is found at once; the outer function holds them for all places
    cut = lambda whole, m: unescape(F.decode(F.substring(whole, (4 * m["start"] + 1).cast("int"), (4 * m["length"]).cast("int")), "UTF-32"))
    under = F.transform(F.array(F.encode("formatted", "UTF-32")), lambda whole: F.transform("mask", lambda m: cut(whole, m)))
    return df.select(conv, F.flatten(F.transform(blocks, parsed)).alias("turns"), under[0].alias("loss"), "formatted")
