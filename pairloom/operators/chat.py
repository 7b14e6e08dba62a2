"""Chat rendering. A chat format is data: the strings around each message."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.constants import SYSTEM_MESSAGE
from pairloom.functions.text import strip
from pairloom.schemas import MESSAGES


@dataclass(frozen=True)
class ChatFormat:
    bos: str
    role_prefix: str
    role_suffix: str
    eot: str
    trim: bool = False

    @property
    def gen_prefix(self) -> str:
        return f"{self.role_prefix}assistant{self.role_suffix}"


CHATML = ChatFormat(bos="", role_prefix="<|im_start|>", role_suffix="\n", eot="<|im_end|>\n")
HEADERS = ChatFormat(
    bos="<|begin_of_text|>",
    role_prefix="<|start_header_id|>",
    role_suffix="<|end_header_id|>\n\n",
    eot="<|eot_id|>",
    trim=True,
)


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def messages_of(inputs: Column, targets: Column | None = None, system: str | None = None) -> Column:
    """`[system?, user, assistant?]` as an array of messages."""
    turns = [message("system", F.lit(system))] if system else []
    turns.append(message("user", inputs))
    if targets is not None:
        turns.append(message("assistant", targets))
    return F.array(*turns).cast(MESSAGES)


def ensure_system(messages: str | Column, system_message: str | None = SYSTEM_MESSAGE) -> Column:
    """Prepend a system message unless the first turn is one; an empty list is an error."""
    messages = F.col(messages) if isinstance(messages, str) else messages
    if not system_message:
        return messages
    empty = F.raise_error(F.lit("a conversation needs at least one message"))
    system = F.array(message("system", F.lit(system_message))).cast(MESSAGES)
    return (
        F.when(F.size(messages) == 0, empty.cast(MESSAGES))
        .when(F.get(messages, F.lit(0))["role"] == "system", messages)
        .otherwise(F.concat(system, messages.cast(MESSAGES)))
    )


def ensure_system_turns(
    df: DataFrame,
    system_message: str | None = SYSTEM_MESSAGE,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """The same for long conversations, one row per turn: adds a turn before the first one.

    The first role is a map-side-combined aggregate, so no conversation is gathered.
    """
    turns = df.select(conv, turn, role, text)
    if not system_message:
        return turns
    opening = df.groupBy(conv).agg(F.min(turn).alias(turn), F.min_by(role, turn).alias(role))
    added = opening.where(~F.col(role).eqNullSafe("system")).select(
        conv,
        (F.col(turn) - 1).cast(df.schema[turn].dataType).alias(turn),
        F.lit("system").alias(role),
        F.lit(system_message).alias(text),
    )
    return turns.unionByName(added)


def render_turn(role: Column, content: Column, fmt: ChatFormat = CHATML) -> Column:
    """One message in the format; turns in order after `bos` make the whole chat."""
    body = strip(content) if fmt.trim else content
    return F.concat(F.lit(fmt.role_prefix), role, F.lit(fmt.role_suffix), body, F.lit(fmt.eot))


def render_messages(messages: str | Column, fmt: ChatFormat = CHATML, generation: bool = False) -> Column:
    """Messages to one string, with the assistant's turn left open when `generation`."""
    messages = F.col(messages) if isinstance(messages, str) else messages
    turns = F.transform(messages, lambda m: render_turn(m["role"], m["content"], fmt))
    return F.concat(F.lit(fmt.bos), F.array_join(turns, ""), F.lit(fmt.gen_prefix if generation else ""))


def render_chat(
    df: DataFrame,
    fmt: ChatFormat = CHATML,
    system: str | None = SYSTEM_MESSAGE,
    inputs: str = "inputs",
    targets: str = "targets",
    out: str = "prompt",
) -> DataFrame:
    """Add the rendered `[system?, user, assistant]` chat; other columns are carried."""
    return df.withColumn(out, render_messages(messages_of(F.col(inputs), F.col(targets), system), fmt))


def render_generation_prompt(
    df: DataFrame,
    fmt: ChatFormat = CHATML,
    system: str | None = SYSTEM_MESSAGE,
    inputs: str = "inputs",
    out: str = "prompt",
) -> DataFrame:
    """Add `[system?, user]` with the assistant's turn open.

    The default system message is the training one; pass `None` to leave it out.
    """
    return df.withColumn(out, render_messages(messages_of(F.col(inputs), None, system), fmt, generation=True))


def split_response(generated: str | Column, mode: str = "strict", fmt: ChatFormat = CHATML) -> Column:
    """Generated text to `struct<user, assistant>`.

    `strict` cuts at the first literal "assistant" and deletes every "user" before
    it. `tagged` cuts at the format's own assistant tag and takes the last user turn.
    """
    generated = F.col(generated) if isinstance(generated, str) else generated
    if mode == "strict":
        parts = F.split(generated, "assistant", 2)
        user = strip(F.replace(F.get(parts, F.lit(0)), F.lit("user"), F.lit("")))
        assistant = strip(F.coalesce(F.get(parts, F.lit(1)), F.lit("")))
    elif mode == "tagged":
        cut = F.instr(generated, fmt.gen_prefix)
        opening = f"{fmt.role_prefix}user{fmt.role_suffix}"
        before = F.when(cut > 0, F.left(generated, cut - 1)).otherwise(generated)
        after = F.when(cut > 0, F.substring(generated, cut + len(fmt.gen_prefix), F.length(generated)))
        user = strip(F.replace(F.substring_index(before, opening, -1), F.lit(fmt.eot), F.lit("")))
        assistant = strip(F.replace(F.coalesce(after, F.lit("")), F.lit(fmt.eot), F.lit("")))
    else:
        raise ValueError(f"mode must be 'strict' or 'tagged', not {mode!r}")
    return F.struct(user.alias("user"), assistant.alias("assistant"))


def split_responses(df: DataFrame, column: str = "generated_text", mode: str = "strict", fmt: ChatFormat = CHATML) -> DataFrame:
    """Replace a generated text column by `user` and `assistant`; other columns are carried.

    A frame that has one of the two columns already is refused.
    """
    taken = {"user", "assistant"} & (set(df.columns) - {column})
    if taken:
        raise ValueError(f"the frame has a column {sorted(taken)} already: rename it first")
    return (
        df.withColumn("__split", split_response(column, mode, fmt))
        .select("*", "__split.user", "__split.assistant")
        .drop("__split", column)
    )
