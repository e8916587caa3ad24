"""Secret scans: fixed patterns, and automata inferred from labelled credentials.

The automata are inferred once, on the driver, from a small table of labelled
credentials and go out with the function; texts are scanned where they are read.
"""

import re
import string
from collections.abc import Iterable, Iterator, Mapping
from functools import cache
from hashlib import sha256
from random import Random

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldwatch.llm.automata import Automaton, classes, infer
from fieldwatch.llm.common import documents_of, free_name

# The patterns that are always reported, with their kinds, in order.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "format")
SHORTEST_ASSIGNED = 6
SHORTEST_ACCESS = 20

KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: Characters of what the automata score: runs as long as the shortest credential they know.
CANDIDATE = "[A-Za-z0-9+/_.=-]"
#: Left out at the ends where a span of a pattern is cut out of a run.
SEPARATORS = "+/_.=-"
#: Log-likelihood per character that a format must have over ordinary text.
MARGIN = 0.35
EXAMPLES = 400
REDACTED = "[secret]"
#: Likelihoods that a task remembers.
REMEMBERED = 1 << 16

ALNUM = string.ascii_letters + string.digits
LOWER_HEX = "0123456789abcdef"
#: Formats of the labelled table: literal pieces, and alphabets with the lengths drawn from them.
FORMATS = {
    "hex": [(LOWER_HEX, (32, 40, 64))],
    "access-key": ["AKIA", (string.ascii_uppercase + string.digits, (16,))],
    "personal-token": ["ghp_", (ALNUM, (36,))],
    "cloud-key": ["AIza", (ALNUM + "-_", (35,))],
    "payment-key": ["sk_live_", (ALNUM, (24, 32))],
    "chat-token": ["xoxb-", (string.digits, (10, 11, 12)), "-", (string.digits, (10, 11, 12)), "-", (ALNUM, (24,))],
    "mail-key": ["SG.", (ALNUM + "-_", (22,)), ".", (ALNUM + "-_", (43,))],
    "base64": [(ALNUM + "+/", (40, 44))],
    "generated": [(ALNUM, (12, 16, 20, 24, 32))],
}
#: Ordinary strings with a fixed form.
FORMS = {
    "uuid": [(LOWER_HEX, (8,)), "-", (LOWER_HEX, (4,)), "-", (LOWER_HEX, (4,)), "-", (LOWER_HEX, (4,)), "-", (LOWER_HEX, (12,))],
    "time": [(string.digits, (4,)), "-", (string.digits, (2,)), "-", (string.digits, (2,)), "T", (string.digits, (2, 6))],
    "number": [(string.digits, tuple(range(2, 24)))],
}
#: How often words of ordinary strings have 2, 3, up to 12 letters.
WORD_LENGTHS = (1, 3, 4, 4, 4, 3, 3, 2, 2, 1, 1)
#: How the names of ordinary strings begin.
ORDINARY = "ordinary"


def spelled(parts: list, rnd: Random) -> str:
    """A string of a format."""
    return "".join(
        part if isinstance(part, str) else "".join(rnd.choices(part[0], k=rnd.choice(part[1]))) for part in parts
    )


def ordinary_strings(rnd: Random, count: int) -> Iterable[tuple[str, str]]:
    """Words, names, paths and rulers as they stand in texts."""

    def word() -> str:
        length = rnd.choices(range(2, 13), WORD_LENGTHS)[0]
        return "".join(rnd.choices(string.ascii_lowercase, k=length))

    for _ in range(8 * count):
        parts = [
            rnd.choice([word(), word().capitalize(), word().upper(), "".join(rnd.choices(string.digits, k=rnd.randint(1, 16)))])
            for _ in range(rnd.randint(1, 6))
        ]
        yield rnd.choice(["-", "_", ".", "/", "="]).join(parts), "joined"
    for _ in range(2 * count):
        words = [word() for _ in range(rnd.randint(1, 5))]
        number = rnd.choice(["", "", str(rnd.randrange(10_000))])
        yield rnd.choice(["", "-", "_"]).join(words).upper() + number, "upper"
        yield words[0] + "".join(map(str.capitalize, words[1:])) + number, "camel"
        yield "".join(map(str.capitalize, words)) + number, "camel"
        yield "".join(words) + number, "lower"
    for _ in range(count):
        yield rnd.choice("-_./=+" + ALNUM) * (2 + int(rnd.expovariate(1 / 30))), "ruler"


def labelled_credentials(examples: int = EXAMPLES, seed: int = 5) -> list[tuple[str, str]]:
    """Credentials with their format, and ordinary strings, whose names begin with ``ORDINARY``."""
    rnd = Random(seed)
    rows = [(spelled(parts, rnd), name) for name, parts in FORMATS.items() for _ in range(examples)]
    for name, parts in FORMS.items():
        for _ in range(examples):
            made = spelled(parts, rnd)
            rows.append((made, f"{ORDINARY}-{name}"))
            rows.append((made.upper(), f"{ORDINARY}-{name}-upper"))
    rows += [(text, f"{ORDINARY}-{name}") for text, name in ordinary_strings(rnd, examples)]
    return rows


class Formats:
    """The automata of formats and of ordinary strings, and the runs that they score."""

    def __init__(self, automata: Mapping[str, Automaton]) -> None:
        self.plain = [automaton for name, automaton in automata.items() if name.startswith(ORDINARY)]
        self.formats = {name: automaton for name, automaton in automata.items() if not name.startswith(ORDINARY)}
        self.shortest = max(1, min((a.shortest() for a in self.formats.values()), default=1))
        self.candidate = re.compile(CANDIDATE + "{%d,}" % self.shortest)
        self.known: dict[str, tuple[float, str]] = {}

    def likelihood(self, text: str) -> tuple[float, str]:
        """Log-likelihood per character over ordinary strings, and the likeliest format."""
        symbols = classes(text)
        if symbols not in self.known:
            plain = max(automaton.log_probability(symbols) for automaton in self.plain)
            best, name = max((a.log_probability(symbols), name) for name, a in self.formats.items())
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[symbols] = (best - plain) / len(text), name
        return self.known[symbols]


@cache
def default_formats() -> Formats:
    return formats_of(labelled_credentials())


def formats_of(labelled: Iterable[tuple[str, str]]) -> Formats:
    """One automaton for each format and each kind of ordinary strings; both must be there."""
    by_format: dict[str, list[str]] = {}
    for text, name in labelled:
        by_format.setdefault(name, []).append(classes(text))
    return Formats({name: infer(examples) for name, examples in by_format.items()})


def beside(text: str, start: int, end: int, spans: Iterable[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """What sorted ``spans`` leave of a run, without separators where it is cut."""
    at = start
    for low, high in [*spans, (end, end)]:
        stop = min(low, end)
        while low < end and at < stop and text[stop - 1] in SEPARATORS:
            stop -= 1
        if at < stop:
            yield at, stop
        if high > at and high > start:
            at = high
            while at < end and high < end and text[at] in SEPARATORS:
                at += 1


def find_secrets(text: str | None, formats: Formats) -> list[tuple[str, int, int]]:
    """Kind, start and end of every secret, by start, then kind as in ``KINDS``.

    ``format`` spans come from the automata. Where a pattern has found a part of a run,
    they score what is left of it on either side.
    """
    text = text or ""
    spans = []
    lowered = text.lower()
    if any(word in lowered for word in KEYWORDS):
        for match in ASSIGN.finditer(text):
            if len(match[2]) >= SHORTEST_ASSIGNED:
                spans.append(("assign", *match.span()))
    if "AKIA" in text:
        for match in ACCESS.finditer(text):
            if match.end() - match.start() >= SHORTEST_ACCESS:
                spans.append(("access", *match.span()))
    spans += [("hex", *match.span()) for match in HEX.finditer(text)]
    taken = sorted((start, end) for _, start, end in spans)
    upcoming = 0
    for match in formats.candidate.finditer(text):
        start, end = match.span()
        while upcoming < len(taken) and taken[upcoming][1] <= start:
            upcoming += 1
        last = upcoming
        while last < len(taken) and taken[last][0] < end:
            last += 1
        for low, high in beside(text, start, end, taken[upcoming:last]):
            if high - low >= formats.shortest and formats.likelihood(text[low:high])[0] >= MARGIN:
                spans.append(("format", low, high))
    return sorted(spans, key=lambda span: (span[1], KINDS.index(span[0])))


def joined(spans: Iterable[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def spans_of(text: Column, formats: Formats) -> Column:
    """All secrets of a text column, as an array of kind, start and end."""
    names = ["kind", "start", "end"]
    kind = pa.list_(pa.struct(list(zip(names, [pa.string(), pa.int64(), pa.int64()], strict=True))))

    @F.arrow_udf("array<struct<kind:string,start:long,end:long>>")
    def found(texts: pa.Array) -> pa.Array:
        rows = [find_secrets(value, formats) for value in texts.to_pylist()]
        return pa.array([[dict(zip(names, s, strict=True)) for s in spans] for spans in rows], kind)

    return found(text)


def scan(docs: DataFrame, formats: Formats | None = None) -> DataFrame:
    """``doc_id`` and ``found``, all secrets of each document in order.

    One row for each row of ``docs``, repeated rows included; null and empty texts
    have none, an empty table gives no rows. Places count code points, ends are
    exclusive. Whole texts of any length are scanned, one at a time.
    """
    spans = spans_of(F.col("text"), formats or default_formats())
    return documents_of(docs).select("doc_id", spans.alias("found"))


def scan_digest(docs: DataFrame) -> DataFrame:
    """Counts per pattern, a digest of their spans, and all spans as text.

    One row for each row of ``docs`` as in ``scan``; a text without secrets has the
    digest of the empty string.
    """
    text = F.transform("found", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    fixed = F.filter("found", lambda s: s["kind"] != "format")
    fixed_text = F.transform(fixed, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))

    def count(kind: str) -> Column:
        found = F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")
        return found.alias(f"n_{kind}")

    return scan(docs).select(
        "doc_id",
        *[count(kind) for kind in KINDS[:3]],
        F.sha2(F.array_join(fixed_text, ","), 256).alias("base_sha256"),
        F.array_join(text, ",").alias("spans"),
    )


def redacted_text(text: str | None, formats: Formats) -> str | None:
    """The text with every run of touching secrets replaced by one mark."""
    spans = find_secrets(text, formats)
    if not spans:
        return text
    parts, done = [], 0
    for _, start, end in spans:
        if start >= done:
            parts += [text[done:start], REDACTED]
        done = max(done, end)
    return "".join([*parts, text[done:]])


def redact(docs: DataFrame, formats: Formats | None = None) -> DataFrame:
    """All rows and columns of ``docs``, with secrets in ``text`` replaced.

    ``n_chars``, where there is one, is counted anew in texts that changed.
    """
    known = formats or default_formats()

    @F.arrow_udf("string")
    def cleaned(texts: pa.Array) -> pa.Array:
        return pa.array([redacted_text(value, known) for value in texts.to_pylist()], pa.string())

    name = free_name(docs, "clean")
    changed = docs.withColumn(name, cleaned(F.col("text").cast("string")))
    if "n_chars" in docs.columns:
        same = F.col(name).eqNullSafe(F.col("text"))
        count = F.length(name).cast(docs.schema["n_chars"].dataType)
        changed = changed.withColumn("n_chars", F.when(same, F.col("n_chars")).otherwise(count))
    return changed.withColumn("text", F.col(name)).drop(name).select(docs.columns)


def digest(spans: Iterable[tuple[str, int, int]]) -> str:
    """The digest of spans as ``scan_digest`` gives it."""
    return sha256(joined(spans).encode()).hexdigest()
