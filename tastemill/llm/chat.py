"""Chat formatting: a small template language, compiled to closures, over conversations.

A template is parsed into a syntax tree, constants are folded, and every node
becomes a Python closure. The language is a sandbox: literals, the fields of a
message, the loop's counters, a few operators and named filters, and nothing
else; an unknown name or filter is an error when the template is compiled, and
no value ever gives access to a Python object.

Texts may hold the template's own control strings. They are escaped reversibly:
a backslash goes in after the first character, and one more where backslashes
stood there already. So a control string in the output is always the template's,
and the output can be read back. ``{% generation %}`` blocks are reported as
spans of code points, the loss mask.

A conversation may hold a third of all rows. Turns are formatted in chunks by
their turn number, one chunk after the other in a task's stream, and what a chunk
must know of the ones before and after it (a count, whether it is the last) is
one small row for each chunk of the conversations that have several. Formatted
text comes in parts of at most 256 turns; a part holds whole turns. Only the
digest of a whole conversation must see its turns in order; that is one stream
with a fixed memory, since SHA-256 cannot be cut.

Defined results: a null text or role is empty; a null conv_id is a conversation
of its own; null turns come first; rows with equal turns are ordered by role,
then text; an empty table has no conversations; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemill.functions.ordered import OrderedSplit
from tastemill.llm.common import map_batches
from tastemill.session import write_stage

# Strings that steer a model of this format.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]", "[/END]")
#: The format of the query. Every turn is marked; what the assistant says is to be learned.
TEMPLATE = """
{%- for message in messages -%}
  {%- if loop.first -%}{{ '<s>' }}{%- endif -%}
  {%- if message.role == 'user' -%}
    {{ '[INST]' + ' ' }}{{ message.text | escape }}{{ ' ' + '[/INST]' }}
  {%- elif message.role == 'assistant' -%}
    {%- generation -%}{{ message.text | escape }}{%- endgeneration -%}
    {{ '</s>' }}
  {%- else -%}
    {{ '[ROLE]' }}{{ message.role | escape }}{{ '[/ROLE]' }}{{ message.text | escape }}{{ '[/END]' }}
  {%- endif -%}
{%- endfor -%}
"""
#: Turn numbers in a chunk, and turns in a part of the output.
CHUNK, PART = 4096, 256

_CONTROL = re.compile(r"([<\[])(\\*)(/?s>|/?INST\]|/?ROLE\]|/END\])")
_ESCAPED = re.compile(r"([<\[])\\(\\*)(/?s>|/?INST\]|/?ROLE\]|/END\])")
_MARK = re.compile("|".join(re.escape(c) for c in CONTROL))


def escape(text: str) -> str:
    return _CONTROL.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


class TemplateError(ValueError):
    """A template that does not parse, or that names what the sandbox does not hold."""


# ---------------------------------------------------------------- syntax

FILTERS: dict[str, Callable[[object], object]] = {
    "escape": lambda x: escape(str(x)),
    "trim": lambda x: str(x).strip(),
    "upper": lambda x: str(x).upper(),
    "lower": lambda x: str(x).lower(),
    "length": lambda x: len(str(x)),
}
#: What a template may read of a message and of its loop.
FIELDS = {"message": ("role", "text"), "loop": ("first", "last", "index", "index0")}

_PIECE = re.compile(r"(\{\{-?|\{%-?|\{#)")
_CLOSE = {"{{": "}}", "{%": "%}", "{#": "#}"}
_TOKEN = re.compile(
    r"""\s*(?:(?P<string>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)"""
    r"""|(?P<op>==|!=|<=|>=|[-+~<>|.()\[\]]))"""
)
_WORDS = {"and", "or", "not", "if", "else", "in", "true", "false", "none"}
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


def _pieces(source: str) -> list[tuple[str, str]]:
    """(kind, body) with kinds text, expression and statement; ``-`` trims the text beside a tag."""
    out: list[tuple[str, str]] = []
    at, trim = 0, False
    while at < len(source):
        found = _PIECE.search(source, at)
        text = source[at : found.start()] if found else source[at:]
        if trim:
            text = text.lstrip()
        if found and found.group().endswith("-"):
            text = text.rstrip()
        if text:
            out.append(("text", text))
        if not found:
            break
        kind = found.group()[:2]
        end = _end_of_tag(source, found.end(), _CLOSE[kind], kind != "{#")
        body = source[found.end() : end]
        trim = body.endswith("-") and kind != "{#"
        if kind != "{#":
            out.append(("expression" if kind == "{{" else "statement", body[:-1] if trim else body))
        at = end + 2
    return out


def _end_of_tag(source: str, at: int, close: str, strings: bool) -> int:
    """Where the tag that opens before ``at`` closes; a closing mark in a string is not one."""
    quoted = re.compile(r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|""" + re.escape(close), re.S)
    pattern = quoted if strings else re.compile(re.escape(close))
    for found in pattern.finditer(source, at):
        if found.group() == close:
            return found.start()
    raise TemplateError(f"a tag is not closed with {close}")


class _Parser:
    """Precedence climbing over the tokens of one expression."""

    def __init__(self, body: str):
        self.tokens: list[tuple[str, str]] = []
        at = 0
        body = body.rstrip()
        while at < len(body):
            found = _TOKEN.match(body, at)
            if not found:
                raise TemplateError(f"cannot read {body[at:]!r}")
            self.tokens.append((found.lastgroup, found.group(found.lastgroup)))
            at = found.end()
        self.at = 0

    def peek(self) -> str:
        kind, text = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
        return text if kind in ("op", "name") else ""

    def take(self, *wanted: str) -> str:
        if self.peek() in wanted and self.peek():
            self.at += 1
            return self.tokens[self.at - 1][1]
        return ""

    def need(self, text: str) -> None:
        if not self.take(text):
            raise TemplateError(f"{text!r} is missing")

    def name(self) -> str:
        kind, text = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
        if kind != "name" or text in _WORDS:
            raise TemplateError(f"a name is missing before {text!r}")
        self.at += 1
        return text

    def whole(self) -> tuple:
        tree = self.choice()
        if self.at < len(self.tokens):
            raise TemplateError(f"{self.tokens[self.at][1]!r} is not expected")
        return tree

    def choice(self) -> tuple:
        tree = self.either()
        if self.take("if"):
            condition = self.either()
            other = self.choice() if self.take("else") else ("const", "")
            return ("choice", condition, tree, other)
        return tree

    def _left(self, names: tuple[str, ...], below: Callable[[], tuple]) -> tuple:
        tree = below()
        while op := self.take(*names):
            tree = (op, tree, below())
        return tree

    def either(self) -> tuple:
        return self._left(("or",), self.both)

    def both(self) -> tuple:
        return self._left(("and",), self.negated)

    def negated(self) -> tuple:
        return ("not", self.negated()) if self.take("not") else self.compared()

    def compared(self) -> tuple:
        return self._left(("==", "!=", "<", ">", "<=", ">=", "in"), self.added)

    def added(self) -> tuple:
        return self._left(("+", "-", "~"), self.filtered)

    def filtered(self) -> tuple:
        tree = self.simple()
        while self.take("|"):
            name = self.name()
            if name not in FILTERS:
                raise TemplateError(f"no filter is called {name!r}")
            tree = ("filter", name, tree)
        return tree

    def simple(self) -> tuple:
        if self.take("("):
            tree = self.choice()
            self.need(")")
            return tree
        if self.at >= len(self.tokens):
            raise TemplateError("an expression ends too soon")
        kind, text = self.tokens[self.at]
        if kind == "string":
            self.at += 1
            return ("const", re.sub(r"\\(.)", lambda m: _ESCAPES.get(m.group(1), m.group(1)), text[1:-1], flags=re.S))
        if kind == "number":
            self.at += 1
            return ("const", int(text))
        if word := self.take("true", "false", "none"):
            return ("const", {"true": True, "false": False, "none": None}[word])
        name = self.name()
        if self.take("."):
            return ("field", name, self.name())
        if self.take("["):
            kind, text = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
            if kind != "string":
                raise TemplateError("a field is named by a string")
            self.at += 1
            self.need("]")
            return ("field", name, text[1:-1])
        return ("name", name)


def parse(source: str) -> list[tuple]:
    """The syntax tree of a template: a list of statements, each a tuple with its kind first."""
    pieces = _pieces(source)
    tree, at = _block(pieces, 0, ())
    if at < len(pieces):
        raise TemplateError(f"{pieces[at][1].strip()!r} has no beginning")
    return tree


def _block(pieces: list[tuple[str, str]], at: int, ends: tuple[str, ...]) -> tuple[list[tuple], int]:
    """Statements up to one of ``ends``, and where that is."""
    out: list[tuple] = []
    while at < len(pieces):
        kind, body = pieces[at]
        at += 1
        if kind == "text":
            out.append(("put", ("const", body)))
        elif kind == "expression":
            out.append(("put", _Parser(body).whole()))
        else:
            word, _, rest = body.strip().partition(" ")
            if word in ends:
                return out, at - 1
            if word == "if":
                statement, at = _branches(pieces, at, rest)
            elif word == "for":
                found = re.fullmatch(r"(\w+)\s+in\s+messages", rest.strip())
                if not found or found.group(1) in _WORDS | {"loop", "messages"}:
                    raise TemplateError(f"cannot loop over {rest!r}")
                inner, at = _closed(pieces, at, "endfor")
                statement = ("for", found.group(1), inner)
            elif word == "set":
                name, sign, value = rest.partition("=")
                if not sign or not re.fullmatch(r"[A-Za-z_]\w*", name.strip()) or name.strip() in _WORDS | {"loop"}:
                    raise TemplateError(f"cannot set {rest!r}")
                statement = ("set", name.strip(), _Parser(value).whole())
            elif word == "generation":
                inner, at = _closed(pieces, at, "endgeneration")
                statement = ("generation", inner)
            else:
                raise TemplateError(f"no statement is called {word!r}")
            out.append(statement)
    if ends:
        raise TemplateError(f"{' or '.join(ends)} is missing")
    return out, at


def _closed(pieces: list, at: int, end: str) -> tuple[list[tuple], int]:
    inner, at = _block(pieces, at, (end,))
    return inner, at + 1


def _branches(pieces: list, at: int, condition: str) -> tuple[tuple, int]:
    test = _Parser(condition).whole()
    yes, at = _block(pieces, at, ("elif", "else", "endif"))
    word, _, rest = pieces[at][1].strip().partition(" ")
    at += 1
    if word == "endif":
        return ("if", test, yes, []), at
    if word == "elif":
        no, at = _branches(pieces, at, rest)
        return ("if", test, yes, [no]), at
    no, at = _closed(pieces, at, "endif")
    return ("if", test, yes, no), at


# ---------------------------------------------------------------- folding

_BINARY: dict[str, Callable] = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    ">": lambda a, b: a > b,
    "<=": lambda a, b: a <= b,
    ">=": lambda a, b: a >= b,
    "in": lambda a, b: str(a) in str(b),
    "+": lambda a, b: a + b,
    "-": lambda a, b: a - b,
    "~": lambda a, b: _shown(a) + _shown(b),
}


def _shown(value: object) -> str:
    return "" if value is None else str(value)


def folded(tree: tuple) -> tuple:
    """An expression with everything that does not depend on a message worked out."""
    kind = tree[0]
    if kind in ("const", "name", "field"):
        return tree
    if kind == "filter":
        inner = folded(tree[2])
        return ("const", FILTERS[tree[1]](inner[1])) if inner[0] == "const" else ("filter", tree[1], inner)
    parts = [folded(x) for x in tree[1:]]
    fixed = [p[0] == "const" for p in parts]
    if kind == "choice" and fixed[0]:
        return parts[1] if parts[0][1] else parts[2]
    if kind in ("and", "or") and fixed[0]:
        return parts[1] if bool(parts[0][1]) == (kind == "and") else parts[0]
    if kind == "not" and fixed[0]:
        return ("const", not parts[0][1])
    if kind in _BINARY and all(fixed):
        try:
            return ("const", _BINARY[kind](parts[0][1], parts[1][1]))
        except TypeError as error:
            raise TemplateError(str(error)) from error
    return (kind, *parts)


def fold(statements: list[tuple]) -> list[tuple]:
    """Statements with folded expressions, decided branches taken and neighbouring texts joined."""
    out: list[tuple] = []
    for kind, *rest in statements:
        if kind == "put":
            value = folded(rest[0])
            if value[0] == "const":
                text = _shown(value[1])
                if out and out[-1][0] == "put" and out[-1][1][0] == "const":
                    out[-1] = ("put", ("const", out[-1][1][1] + text))
                elif text:
                    out.append(("put", ("const", text)))
            else:
                out.append(("put", value))
        elif kind == "if":
            test, yes, no = folded(rest[0]), fold(rest[1]), fold(rest[2])
            if test[0] == "const":
                out = fold(out + (yes if test[1] else no))
            else:
                out.append(("if", test, yes, no))
        elif kind == "set":
            out.append(("set", rest[0], folded(rest[1])))
        else:
            out.append((kind, *rest[:-1], fold(rest[-1])))
    return out


# ---------------------------------------------------------------- closures


class Output:
    """Text written so far, and the spans of its generation blocks in code points."""

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.size = 0
        self.spans: list[tuple[int, int]] = []

    def put(self, text: str) -> None:
        self.parts.append(text)
        self.size += len(text)


def _value(tree: tuple, known: frozenset[str], loop: str | None) -> Callable[[dict], object]:
    kind = tree[0]
    if kind == "const":
        fixed = tree[1]
        return lambda env: fixed
    if kind == "name":
        name = tree[1]
        if name not in known:
            raise TemplateError(f"the name {name!r} is not known here")
        return lambda env: env[name]
    if kind == "field":
        name, field = tree[1:]
        if loop is None or name not in (loop, "loop"):
            raise TemplateError(f"{name!r} has no fields here")
        if field not in FIELDS["loop" if name == "loop" else "message"]:
            raise TemplateError(f"{name!r} has no field {field!r}")
        place = (name == "loop", field)
        return lambda env: env[place]
    if kind == "filter":
        apply, inner = FILTERS[tree[1]], _value(tree[2], known, loop)
        return lambda env: apply(inner(env))
    parts = [_value(x, known, loop) for x in tree[1:]]
    if kind == "not":
        (inner,) = parts
        return lambda env: not inner(env)
    if kind == "choice":
        test, yes, no = parts
        return lambda env: yes(env) if test(env) else no(env)
    left, right = parts
    if kind == "and":
        return lambda env: left(env) and right(env)
    if kind == "or":
        return lambda env: left(env) or right(env)
    apply = _BINARY[kind]
    return lambda env: apply(left(env), right(env))


Run = Callable[[dict, Output], None]


def _together(runs: list[Run]) -> Run:
    def run(env: dict, out: Output) -> None:
        for one in runs:
            one(env, out)

    return runs[0] if len(runs) == 1 else run


def _closures(statements: list[tuple], known: frozenset[str], loop: str | None) -> tuple[Run, frozenset[str]]:
    runs: list[Run] = []
    for kind, *rest in statements:
        if kind == "put":
            runs.append(_put(_value(rest[0], known, loop), rest[0]))
        elif kind == "set":
            runs.append(_set(rest[0], _value(rest[1], known, loop)))
            known |= {rest[0]}
        elif kind == "if":
            yes, in_yes = _closures(rest[1], known, loop)
            no, in_no = _closures(rest[2], known, loop)
            runs.append(_if(_value(rest[0], known, loop), yes, no))
            known |= in_yes & in_no
        elif kind == "generation":
            inner, known = _closures(rest[0], known, loop)
            runs.append(_generation(inner))
        else:
            raise TemplateError("messages are looped over once, outside of any other block")
    return _together(runs), known


def _put(value: Callable, tree: tuple) -> Run:
    if tree[0] == "const":
        text = tree[1]
        return lambda env, out: out.put(text)
    return lambda env, out: out.put(_shown(value(env)))


def _set(name: str, value: Callable) -> Run:
    def run(env: dict, out: Output) -> None:
        env[name] = value(env)

    return run


def _if(test: Callable, yes: Run, no: Run) -> Run:
    return lambda env, out: yes(env, out) if test(env) else no(env, out)


def _generation(inner: Run) -> Run:
    def run(env: dict, out: Output) -> None:
        start = out.size
        inner(env, out)
        out.spans.append((start, out.size))

    return run


class Template:
    """Closures for what stands before, in and after the loop over the messages.

    Split in this way, a conversation is written turn by turn and never held.
    What is set in the loop is known in the rest of the same turn only.
    """

    def __init__(self, source: str):
        tree = fold(parse(source))
        loops = [i for i, s in enumerate(tree) if s[0] == "for"]
        if len(loops) != 1:
            raise TemplateError("a template has one loop over messages")
        at = loops[0]
        self._before, known = _closures(tree[:at], frozenset(), None)
        self._turn, _ = _closures(tree[at][2], known, tree[at][1])
        self._after, _ = _closures(tree[at + 1 :], known, None)

    def start(self) -> tuple[dict, Output]:
        env: dict = {}
        out = Output()
        self._before(env, out)
        return env, out

    def turn(self, env: dict, out: Output, role: str, text: str, index: int, last: bool) -> None:
        inside = {
            **env,
            (False, "role"): role,
            (False, "text"): text,
            (True, "first"): index == 0,
            (True, "last"): last,
            (True, "index"): index + 1,
            (True, "index0"): index,
        }
        self._turn(inside, out)

    def end(self, env: dict, out: Output) -> None:
        self._after(env, out)

    def render(self, messages: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
        """The text and the generation spans of one conversation of (role, text)."""
        env, out = self.start()
        for i, (role, text) in enumerate(messages):
            self.turn(env, out, role, text, i, i + 1 == len(messages))
        self.end(env, out)
        return "".join(out.parts), out.spans


@lru_cache(maxsize=16)
def compiled(source: str) -> Template:
    return Template(source)


# ---------------------------------------------------------------- conversations

_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
_PART_SCHEMA = "conv_id {}, chunk bigint, part bigint, text string, loss array<struct<start: int, stop: int>>"


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _with_last(rows: Iterator[tuple], more: bool) -> Iterator[tuple[tuple, bool]]:
    """Each row, and whether it is the last of its conversation."""
    row = next(rows, None)
    while row is not None:
        following = next(rows, None)
        yield row, following is None and not more
        row = following


def _format(source: str, part_turns: int):
    """Parts of each chunk; rows come sorted by conversation and chunk, with a head row first where there is one."""

    def parts(rows: Iterator[tuple]) -> Iterator[tuple]:
        template = compiled(source)
        for (conv, chunk), group in groupby(rows, key=lambda r: r[:2]):
            first = next(group)
            index, more = (first[4], first[5]) if first[2] == 0 else (0, False)
            if first[2] == 1:
                group = _again(first, group)
            env, out = template.start()
            if index:
                out = Output()
            part = turns = 0
            for (_, _, _, _, _, _, role, text), last in _with_last(group, more):
                template.turn(env, out, role, text, index, last)
                index, turns = index + 1, turns + 1
                if last:
                    template.end(env, out)
                elif turns == part_turns:
                    yield conv, chunk, part, "".join(out.parts), out.spans
                    part, turns, out = part + 1, 0, Output()
            if turns:
                yield conv, chunk, part, "".join(out.parts), out.spans

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None

        def watched() -> Iterator[pa.RecordBatch]:
            nonlocal kind
            for batch in batches:
                kind = batch.schema.field(0).type
                yield batch

        held: list[tuple] = []
        size = 0
        for one in parts(_stream(watched())):
            held.append(one)
            size += len(one[3])
            if size > 1 << 20 or len(held) == 1024:
                yield _part_batch(held, kind)
                held, size = [], 0
        if held:
            yield _part_batch(held, kind)

    return run


def _again(first: tuple, rest: Iterator[tuple]) -> Iterator[tuple]:
    yield first
    yield from rest


def _part_batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    conv, chunk, part, text, loss = zip(*rows)
    spans = [[{"start": a, "stop": b} for a, b in found] for found in loss]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(conv, kind),
            pa.array(chunk, pa.int64()),
            pa.array(part, pa.int64()),
            pa.array(text, pa.string()),
            pa.array(spans, _SPANS),
        ],
        names=["conv_id", "chunk", "part", "text", "loss"],
    )


_TURN = ["conv_id", "chunk", "kind", "turn", "before", "more", "role", "text"]


def _turns(conversations: DataFrame, chunk: int) -> DataFrame:
    c = conversations
    return c.select(
        c["conv_id"].alias("conv_id"),
        F.coalesce(F.floor(c["turn"] / F.lit(chunk)), F.lit(-(2**62))).cast("bigint").alias("chunk"),
        F.lit(1).alias("kind"),
        c["turn"].cast("bigint").alias("turn"),
        F.lit(None).cast("bigint").alias("before"),
        F.lit(None).cast("boolean").alias("more"),
        F.coalesce(c["role"].cast("string"), F.lit("")).alias("role"),
        F.coalesce(c["text"].cast("string"), F.lit("")).alias("text"),
    )


def _heads(turns: DataFrame) -> DataFrame:
    """One row for each chunk of the conversations that have several: turns before it, and whether more follow.

    Only counts are shuffled for this, with one row per task and chunk.
    """
    sizes = write_stage(turns.groupBy("conv_id", "chunk").agg(F.count(F.lit(1)).alias("size")), "chunks")
    several = sizes.groupBy("conv_id").agg(F.count(F.lit(1)).alias("chunks")).filter("chunks > 1")
    known = sizes.join(
        several.select(F.col("conv_id").alias("_id")), F.col("conv_id").eqNullSafe(F.col("_id")), "left_semi"
    )
    # The ordered scan wants keys without nulls.
    named = known.withColumn("null_id", F.col("conv_id").isNull()).withColumn(
        "name", F.coalesce(F.col("conv_id").cast("string"), F.lit(""))
    )
    if named.isEmpty():
        return named.select("conv_id", "chunk", F.lit(0).cast("bigint").alias("before"), F.lit(True).alias("more"))
    placed = (
        OrderedSplit(named, ["null_id", "name"], ["chunk"])
        .running_sum(F.col("size"), "before", inclusive=False)
        .key_total(F.col("size"), "total")
        .result()
    )
    return write_stage(
        placed.select(
            "conv_id",
            "chunk",
            F.col("before").cast("bigint").alias("before"),
            (F.col("before") + F.col("size") < F.col("total")).alias("more"),
        ),
        "chunk-heads",
    )


def _parts(turns: DataFrame, template: str, part_turns: int) -> DataFrame:
    kind = turns.schema["conv_id"].dataType.simpleString()
    ordered = turns.select(*_TURN).repartition("conv_id", "chunk").sortWithinPartitions(
        "conv_id", "chunk", "kind", "turn", "role", "text"
    )
    return map_batches(ordered, _format(template, part_turns), _PART_SCHEMA.format(kind))


def formatted(
    conversations: DataFrame, template: str = TEMPLATE, chunk: int = CHUNK, part_turns: int = PART
) -> tuple[DataFrame, DataFrame | None]:
    """(conv_id, chunk, part, text, loss): the formatted conversations, in parts that follow each other.

    The first table has the conversations of one chunk, the second, if there are
    any, those of several. ``loss`` holds the generation blocks as spans of code
    points of the part.
    """
    Template(template)  # a faulty template fails here and not in the tasks
    turns = _turns(conversations, chunk)
    heads = _heads(turns)
    if heads.isEmpty():
        return _parts(turns, template, part_turns), None
    ids = write_stage(heads.select(F.col("conv_id").alias("_id")).distinct(), "long-conversations")
    same = F.col("conv_id").eqNullSafe(F.col("_id"))
    long = turns.join(ids, same, "left_semi")
    first = heads.select(
        "conv_id",
        "chunk",
        F.lit(0).alias("kind"),
        F.lit(None).cast("bigint").alias("turn"),
        "before",
        "more",
        F.lit("").alias("role"),
        F.lit("").alias("text"),
    )
    return (
        _parts(turns.join(ids, same, "left_anti"), template, part_turns),
        _parts(long.unionByName(first), template, part_turns),
    )


# ---------------------------------------------------------------- reading back


def read_turns(text: str) -> list[tuple[str, str]]:
    """(role, text) of the turns in a part that ``TEMPLATE`` wrote."""
    marks = list(_MARK.finditer(text))
    out: list[tuple[str, str]] = []
    at = i = 0
    while i < len(marks):
        mark = marks[i]
        kind, after = mark.group(), mark.end()
        i += 1
        if kind == "<s>":
            at = after
        elif kind == "</s>":
            out.append(("assistant", unescape(text[at : mark.start()])))
            at = after
        elif kind == "[INST]":
            end = marks[i]
            out.append(("user", unescape(text[after + 1 : end.start() - 1])))
            at, i = end.end(), i + 1
        else:
            name, end = marks[i], marks[i + 1]
            out.append((unescape(text[after : name.start()]), unescape(text[name.end() : end.start()])))
            at, i = end.end(), i + 2
    return out


_DIGESTS = [
    ("n_turns", pa.int64()),
    ("turns_sha256", pa.string()),
    ("loss_chars", pa.int64()),
    ("loss_sha256", pa.string()),
    ("formatted_chars", pa.int64()),
]
_DIGEST_SCHEMA = (
    "conv_id {}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
)


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of each conversation from its parts, which come in order; no more than a part is held."""
    kind = None

    def watched() -> Iterator[pa.RecordBatch]:
        nonlocal kind
        for batch in batches:
            kind = batch.schema.field(0).type
            yield batch

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows))
        arrays = [pa.array(columns[0], kind)]
        arrays += [pa.array(c, t) for c, (_, t) in zip(columns[1:], _DIGESTS)]
        return pa.RecordBatch.from_arrays(arrays, names=["conv_id", *(n for n, _ in _DIGESTS)])

    held: list[tuple] = []
    for conv, group in groupby(_stream(watched()), key=lambda r: r[0]):
        turns, learned = hashlib.sha256(), hashlib.sha256()
        count = chars = size = 0
        for _, _, _, text, loss in group:
            for role, said in read_turns(text):
                turns.update(f"{role}\n{said}\n".encode())
                count += 1
            for span in loss:
                said = unescape(text[span["start"] : span["stop"]])
                learned.update(said.encode())
                chars += len(said)
            size += len(text)
        held.append((conv, count, turns.hexdigest(), chars, learned.hexdigest(), size))
        if len(held) == 1024:
            yield batch_of(held)
            held = []
    if held:
        yield batch_of(held)


def digests(conversations: DataFrame, chunk: int = CHUNK, part_turns: int = PART) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), read back from the output."""
    short, long = formatted(conversations, TEMPLATE, chunk, part_turns)
    schema = _DIGEST_SCHEMA.format(short.schema["conv_id"].dataType.simpleString())
    out = map_batches(short, _read_back, schema)
    if long is None:
        return out
    ordered = long.repartition("conv_id").sortWithinPartitions("conv_id", "chunk", "part")
    return out.unionByName(map_batches(ordered, _read_back, schema))
