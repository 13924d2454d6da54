"""Secret scans in DataFrame functions only: fixed patterns and sliding-window entropy."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meteospark.llm.common import fresh

KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = (
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
#: Runs shorter than asked can't hold a longer match, so the least length is part of these two.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: A cheap test for texts in which ASSIGN may match.
_ASSIGN_HINT = r"(?i:(passw|secret|token|api_?key)[a-z]*)[\"']?\x20*[:=]"

#: Characters of one entropy window, and candidate strings.
WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: A part of a candidate between its '=', '-', '_' and '/'.
PART = r"[A-Za-z0-9+]{20,}"
#: (name, the characters of a window, its least entropy in bits); the first class that has them all counts.
#: A window has the class of its own characters, so NAME=VALUE with a hex value has the limit of hex inside
#: the value. Letters alone spell words and names, so they have a limit that only mixed random ones reach.
CLASSES = (
    ("hex", "0123456789abcdefABCDEF", 3.0),
    ("letters", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", 4.0),
    ("alphanumeric", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 3.6),
    ("base64", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-", 3.9),
)
#: Candidates that are no secrets: numbers, version-4 style ids, words or paths of one case.
ALLOWED = (
    r"^[^A-Za-z]*$",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^/?([a-z]+|[A-Z]+|[0-9]+)([-_/]([a-z]+|[A-Z]+|[0-9]+))*/?$",
)

_SPAN = "struct<start:int,kind:int,end:int>"
_PLACE = "struct<start:int,end:int,word:string>"
_CHUNK = 256


def _empty(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def _let(value: Column, use) -> Column:
    """use(value), with the value worked out once however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _gather(items: Column, kind: str, start: Column, step) -> Column:
    """Runs `step(state, item)`, which gives the next state and an element or null, over an array.

    Elements are appended to short arrays that are joined at the end, so many matches in one long text
    don't cost their square.
    """
    state = F.struct(start.alias("state"), _empty(kind).alias("open"), F.array().cast(f"array<array<{kind}>>").alias("full"))

    def merge(acc, item):
        state, made = step(acc["state"], item)
        full = F.size(acc["open"]) >= _CHUNK
        added = F.when(made.isNull(), _empty(kind)).otherwise(F.array(made))
        return F.struct(
            state.alias("state"),
            F.when(full, added).otherwise(F.concat(acc["open"], added)).alias("open"),
            F.when(full, F.concat(acc["full"], F.array(acc["open"]))).otherwise(acc["full"]).alias("full"),
        )

    return F.aggregate(
        items,
        state,
        merge,
        lambda acc: F.struct(acc["state"].alias("state"), F.concat(F.flatten(acc["full"]), acc["open"]).alias("made")),
    )


def located(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches as (start, end, word); code points, end exclusive; word: the group."""
    matches = _let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda whole: F.zip_with(
            F.zip_with(
                whole,
                F.slice(F.split(text, pattern, -1), 1, F.size(whole)),
                lambda m, g: F.struct(F.length(m).alias("m"), F.length(g).alias("g")),
            ),
            whole if not group else F.regexp_extract_all(text, F.lit(pattern), F.lit(group)),
            lambda a, w: F.struct(a["m"].alias("m"), a["g"].alias("g"), w.alias("w")),
        ),
    )

    def step(at, x):
        begin = at + x["g"]
        end = begin + x["m"]
        return end, F.struct(begin.alias("start"), end.alias("end"), x["w"].alias("word")).cast(_PLACE)

    return _gather(matches, _PLACE, F.lit(0), step)["made"]


def _spans(kind: int, places: Column) -> Column:
    return F.transform(
        places,
        lambda p: F.struct(p["start"].alias("start"), F.lit(kind).alias("kind"), p["end"].alias("end")).cast(_SPAN),
    )


def entropy_runs(word: Column, window: int = WINDOW) -> Column:
    """(start, end) of the maximal runs covered by windows whose Shannon entropy reaches their class's limit.

    A window's sum of c * log2(c), and for each class how many of its characters don't belong, are kept up
    to date by the one character that enters and the one that leaves; nothing is counted anew. Words
    shorter than a window have no run.
    """
    weigh = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 2)])
    count = lambda text, ch: F.length(text) - F.length(F.replace(text, ch, F.lit("")))
    f = lambda c: F.element_at(weigh, c + 1)
    foreign = lambda ch, letters: (F.instr(F.lit(letters), ch) == 0).cast("int")
    start = F.struct(
        F.lit("").alias("win"),
        F.lit(0.0).alias("sum"),
        F.lit(0).alias("n"),
        F.lit(-1).alias("lo"),
        F.lit(-1).alias("hi"),
        *[F.lit(0).alias(name) for name, _, _ in CLASSES[:-1]],
    )

    def step(s, ch):
        full = F.length(s["win"]) >= window
        leaving = F.substring(s["win"], 1, 1)
        gone = count(s["win"], leaving)
        win = F.when(full, F.substring(s["win"], 2, window)).otherwise(s["win"])
        less = F.when(full, f(gone) - f(gone - 1)).otherwise(0.0)
        had = count(win, ch)
        total = s["sum"] - less + f(had + 1) - f(had)
        n = s["n"] + 1
        others, least = [], F.lit(CLASSES[-1][2])
        for name, letters, bits in reversed(CLASSES[:-1]):
            left = F.when(full, foreign(leaving, letters)).otherwise(0)
            outside = s[name] - left + foreign(ch, letters)
            others.append(outside.alias(name))
            least = F.when(outside == 0, bits).otherwise(least)
        high = (n >= window) & (F.lit(math.log2(window)) - total / window >= least - 1e-12)
        apart = high & (s["hi"] < n - window)
        state = F.struct(
            F.concat(win, ch).alias("win"),
            total.alias("sum"),
            n.alias("n"),
            F.when(apart, n - window).otherwise(s["lo"]).alias("lo"),
            F.when(high, n).otherwise(s["hi"]).alias("hi"),
            *reversed(others),
        )
        closed = F.struct(s["lo"].alias("start"), s["hi"].alias("end"), F.lit("").alias("word")).cast(_PLACE)
        return state, F.when(apart & (s["hi"] >= 0), closed)

    return _let(_gather(F.split(word, ""), _PLACE, start, step), _with_last)


def _with_last(done: Column) -> Column:
    """The closed runs and the one still open at the end, if there is one."""
    state = done["state"]
    last = F.struct(state["lo"].alias("start"), state["hi"].alias("end"), F.lit("").alias("word")).cast(_PLACE)
    return F.when(state["hi"] >= 0, F.concat(done["made"], F.array(last))).otherwise(done["made"])


def _allowed(word: Column) -> Column:
    found = F.lit(False)
    for pattern in ALLOWED:
        found = found | word.rlike(pattern)
    return found


def entropy_spans(text: Column) -> Column:
    """Spans of kind entropy: runs of high windows in candidates that no allow-list entry suppresses."""

    def runs(p):
        return F.transform(
            entropy_runs(p["word"]),
            lambda r: F.struct(
                (p["start"] + r["start"]).alias("start"), F.lit(3).alias("kind"), (p["start"] + r["end"]).alias("end")
            ).cast(_SPAN),
        )

    return F.flatten(F.transform(F.filter(located(text, CANDIDATE), lambda p: ~_allowed(p["word"])), runs))


def part_spans(text: Column) -> Column:
    """Spans of kind entropy over the whole of each part of a candidate that has a high window.

    Parts lie between '=', '-', '_' and '/' and have a window's length or more.
    """
    found = _spans(3, F.filter(located(text, PART), lambda p: ~_allowed(p["word"]) & (F.size(entropy_runs(p["word"])) > 0)))
    return F.when(text.rlike(PART), found).otherwise(_empty(_SPAN))


def secret_spans(text: Column) -> Column:
    """All spans of a text as an array of (start, kind, end), sorted. Null: none."""
    text = F.coalesce(text, F.lit(""))
    none = _empty(_SPAN)
    assigned = F.filter(located(text, ASSIGN, group=2), lambda p: F.length(p["word"]) >= 6)
    parts = [
        F.when(text.rlike(_ASSIGN_HINT), _spans(0, assigned)).otherwise(none),
        F.when(text.contains("AKIA"), _spans(1, located(text, ACCESS))).otherwise(none),
        F.when(text.rlike(HEX), _spans(2, located(text, HEX))).otherwise(none),
        F.when(text.rlike(CANDIDATE), entropy_spans(text)).otherwise(none),
    ]
    return F.array_sort(F.concat(*parts))


def span_text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])
    return F.array_join(F.transform(spans, one), ",")


def scan_secrets(docs: DataFrame, text_column: str = "text", out: str = "secret_spans") -> DataFrame:
    """Adds the column `out`, an array of (start, kind, end): code points, end exclusive, sorted.

    kind is a place in KINDS. The three fixed patterns find what they match; entropy adds runs of high
    windows, which may overlap those. Null and empty texts have an empty array, a very long text is one
    row's work. Other columns, their nulls and repeated rows are passed on; an empty table gives no rows.
    """
    return docs.withColumn(out, secret_spans(F.col(text_column)))


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each maximal run of spans replaced by the mark. Null stays null."""
    start = F.struct(F.lit(-1).alias("lo"), F.lit(-1).alias("hi"))

    def step(s, x):
        apart = x["start"] > s["hi"]
        state = F.struct(
            F.when(apart, x["start"]).otherwise(s["lo"]).alias("lo"),
            F.greatest(s["hi"], x["end"]).alias("hi"),
        )
        closed = F.struct(s["lo"].alias("start"), s["hi"].alias("end"), F.lit("").alias("word")).cast(_PLACE)
        return state, F.when(apart & (s["hi"] >= 0), closed)

    def rebuilt(runs):
        def cut(ends):
            before = F.zip_with(
                F.transform(runs, lambda r: r["start"]),
                F.slice(ends, 1, F.size(runs)),
                lambda lo, end: F.concat(F.substr(text, end + 1, lo - end), F.lit(mark)),
            )
            rest = F.substr(text, F.element_at(ends, -1) + 1, F.length(text))
            return F.concat(F.array_join(before, ""), rest)

        return _let(F.concat(F.array(F.lit(0)), F.transform(runs, lambda r: r["end"])), cut)

    runs = _let(_gather(spans, _PLACE, start, step), _with_last)
    return F.when(F.size(spans) > 0, _let(runs, rebuilt)).otherwise(text)


def redact_secrets(docs: DataFrame, text_column: str = "text", chars_column: str = "n_chars") -> DataFrame:
    """Replaces every span in the texts and, where there is such a column, counts their characters anew.

    Besides the spans of `scan_secrets`, whole parts of candidates go once one of their windows is high.
    """
    (found,) = fresh(docs, "_secret_spans")
    scanned = scan_secrets(docs, text_column, found)
    parts = part_spans(F.coalesce(F.col(text_column), F.lit("")))
    scanned = scanned.withColumn(found, F.array_sort(F.concat(found, parts)))
    clean = scanned.withColumn(text_column, redacted(F.col(text_column), F.col(found)))
    if chars_column in docs.columns:
        length = F.length(text_column).cast(docs.schema[chars_column].dataType)
        counted = F.when(F.size(found) > 0, length).otherwise(F.col(chars_column))
        clean = clean.withColumn(chars_column, counted)
    return clean.drop(found)
