"""Repeated runs of lines, found by winnowing and deleted where they come later.

Lines are compared without white space around them; blank lines take no part. The grams of a
document are its pairs of consecutive lines, and each line of ``alone`` characters or more by
itself. Of every two consecutive grams the one of least hash is selected, of equal ones the
later, and each long line: these minima are the only fingerprints. A run of three
lines, or one with a long line, has a fingerprint wherever it stands, and along
a longer run one begins at every second line at least.

Every place of a fingerprint is joined with its first one, in the order of documents
and lines, and the match is extended line by line in both directions, by up to
``window`` lines; what lies beyond is the match of the next fingerprint of the run. A matched
run goes if it has ``window`` lines or a long one, so a heading goes with its
repeated paragraph; a document of two short lines goes as a whole if another one was the
same. Where the first place has other surroundings, the runs of up to ``window`` lines around
the fingerprint are joined with their own first places. So, with a ``window`` of three or more,
every such run that came before goes, whatever the first surroundings of its lines. A run met
n times makes n matches, as none is compared with any but the first.

All of it is DataFrame functions. Grams are named by 128 bits, lines by 64.

Defined cases: a null text stays null and has no lines. Empty texts and blank lines stay as they
are. Rows of equal id and text are one document given several times and all get
the same result; rows without id come first, by the hash of their text. Overlapping
repeats within a document leave the first run. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import column, fresh_name, saved

WINDOW = 3
ALONE = 40

# Lines of a text without white space around them; those that are not blank; and their numbers.
_LINES = "transform(split({text}, '\\n', -1), l -> trim(BOTH ' \\t\\r' FROM l))"
_NUMBERS = "filter(transform(" + _LINES + ", (l, i) -> if(l <> '', i, -1)), i -> i >= 0)"


def _name(lines: str) -> str:
    return f"unhex(md5(CAST({lines} AS BINARY)))"


def fingerprints(docs: DataFrame, window: int, alone: int) -> DataFrame:
    """(id, mark, gram, at, size, weighty, before1, ..., after1, ...): every selected gram.

    ``at`` counts the lines that are not blank, ``size`` is that of the gram. A weighty
    one needs no other lines to go. ``before`` and ``after`` are the hashes of the
    next lines on either side, nearest first. ``docs`` has the columns id, mark and text.
    """
    lines = docs.selectExpr("id", "mark", f"filter({_LINES.format(text='text')}, l -> l <> '') AS ls")
    grams = lines.where("size(ls) > 0").selectExpr(
        "id",
        "mark",
        "transform(ls, l -> xxhash64(l)) AS hashes",
        f"transform(ls, l -> length(l) >= {alone}) AS long",
        # The gram of two short lines that are a document has a name of its own.
        f"""transform(ls, (l, i) -> CASE
              WHEN length(l) >= {alone} THEN {_name("l")}
              WHEN i < size(ls) - 1 THEN {_name(f"""concat(
                if(size(ls) = 2 AND length(ls[i + 1]) < {alone}, '\n', ''), l, '\n', ls[i + 1])""")}
              END) AS grams""",
    )
    selected = grams.selectExpr(
        "*",
        """array_distinct(filter(transform(grams, (g, i) -> CASE
              WHEN long[i] THEN i
              WHEN get(grams, i + 1) IS NOT NULL THEN if(g < grams[i + 1], i, i + 1)
              WHEN size(grams) = 2 AND i = 0 THEN 0 END), i -> i IS NOT NULL)) AS chosen""",
    )
    around = ", ".join(
        f"'before{t}', get(hashes, at - {t}), 'after{t}', get(hashes, at + if(long[at], 0, 1) + {t})"
        for t in range(1, window + 1)
    )
    # Built before they are unnested, as the arrays would be copied with every place.
    return selected.selectExpr(
        "id",
        "mark",
        f"""inline(transform(chosen, at -> named_struct(
              'gram', grams[at],
              'at', at,
              'size', if(long[at], 1, 2),
              'weighty', long[at] OR coalesce(get(long, at + 1), false) OR size(long) = 2,
              {around})))""",
    )


def _equal_lines(side: str, window: int) -> str:
    """How many lines on a side are those of the first place, from the nearest on."""
    count = "0"
    for t in range(window, 0, -1):
        count = f"if(coalesce({side}{t} = first.{side}{t}, false), 1 + {count}, 0)"
    return count


def _later_places(places: DataFrame, key: str, around: Sequence[str] = ()) -> DataFrame:
    """The places whose key has an earlier one, with the ``first`` and its columns ``around``."""
    place = F.struct("id", "mark", "at")
    met = places.groupBy(key).agg(
        F.min(F.struct("id", "mark", "at", *around)).alias("first"), F.max(place).alias("last")
    )
    again = met.where("NOT (named_struct('id', first.id, 'mark', first.mark, 'at', first.at) <=> last)")
    # Stored, so the join has a shuffle on either side and a line that very many
    # documents share is split over tasks.
    again = saved(again.select(key, "first"), "repeated")
    return places.join(again, key).where(~place.eqNullSafe(F.struct("first.id", "first.mark", "first.at")))


def _other_runs(window: int) -> str:
    """The runs around a place that reach beyond its match, as far as others don't cover them.

    Of short lines, a run of ``window`` begins at a fingerprint or one line before. One
    with a long line is that line with those before it, and with those after it.
    """
    short = [(0, max(window - 2, 0)), (1, window - 3)]
    long = [reach for t in range(1, window) for reach in ((t, 0), (0, t))]
    runs = []
    for kind, reaches in (("size = 2 AND NOT weighty", short), ("size = 1", long)):
        for before, after in reaches:
            if after < 0:
                continue
            lines = [f"before{t}" for t in range(1, before + 1)] + [f"after{t}" for t in range(1, after + 1)]
            there = "".join(f" AND {line} IS NOT NULL" for line in lines)
            name = _name(f"concat_ws(',', {', '.join(['hex(gram)', str(before), str(after), *lines])})")
            runs.append(
                f"""if({kind} AND (equal_before < {before} OR equal_after < {after}){there},
                  named_struct('run', {name}, 'begin', at - {before}, 'end', at + size + {after}), NULL)"""
            )
    return f"filter(array({', '.join(runs)}), r -> r IS NOT NULL)"


def repeated_lines(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = WINDOW,
    alone: int = ALONE,
) -> DataFrame:
    """id, mark (hash of the text) and the lines that go, counted from 0 among those not blank."""
    text = column(text_column).cast("string")
    rows = docs.select(column(id_column).alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"))
    # Stored, as they are read twice.
    marks = saved(fingerprints(rows.where(F.col("text").isNotNull()), window, alone), "fingerprints")
    around = [f"{side}{t}" for side in ("before", "after") for t in range(1, window + 1)]
    matches = _later_places(marks, "gram", around).selectExpr(
        "*",
        f"{_equal_lines('before', window)} AS equal_before",
        f"{_equal_lines('after', window)} AS equal_after",
    )
    matches = matches.selectExpr(
        "id",
        "mark",
        "at",
        "at - equal_before AS begin",
        "at + size + equal_after AS end",
        f"weighty OR equal_before + size + equal_after >= {window} AS goes",
        f"{_other_runs(window)} AS others",
    )
    # Stored, as both sides of the second join and the result read them.
    matches = saved(matches.where("goes OR size(others) > 0"), "matches")
    others = matches.selectExpr("id", "mark", "at", "inline(others)")
    runs = (
        matches.where("goes")
        .select("id", "mark", "begin", "end")
        .union(_later_places(others, "run").select("id", "mark", "begin", "end"))
    )
    return (
        runs.select("id", "mark", F.explode(F.sequence("begin", F.col("end") - 1)).alias("line"))
        .groupBy("id", "mark")
        .agg(F.collect_set("line").alias("removed"))
    )


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _kept_text(text: Column, numbers: Column, removed: Column) -> Column:
    lines = F.split(text, "\n", -1)
    gone = F.transform(removed, lambda i: F.get(numbers, i))
    every = F.sequence(F.lit(0), F.size(lines) - 1)
    kept = F.transform(F.array_except(every, gone), lambda i: F.get(lines, i))
    return F.when(removed.isNull(), text).otherwise(F.array_join(kept, "\n"))


def drop_repeated_lines(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = WINDOW,
    alone: int = ALONE,
    lines_column: str | None = None,
    removed_column: str | None = None,
) -> DataFrame:
    """The rows of ``docs`` with all their columns and the cleaned text.

    Where names are given for them, also the numbers of lines before, and of those removed.
    """
    gone = repeated_lines(
        docs, id_column=id_column, text_column=text_column, window=window, alone=alone
    )
    own_id, own_mark, own_lines = (fresh_name(docs, n) for n in ("gone_id", "gone_mark", "gone_lines"))
    gone = gone.select(
        F.col("id").alias(own_id), F.col("mark").alias(own_mark), F.col("removed").alias(own_lines)
    )
    text, removed = column(text_column).cast("string"), column(own_lines)
    same = column(id_column).eqNullSafe(column(own_id)) & (F.xxhash64(text) == column(own_mark))
    joined = docs.join(gone, same, "left")
    numbers = F.expr(_NUMBERS.format(text=f"CAST({_quoted(text_column)} AS STRING)"))
    names = [
        _kept_text(text, numbers, removed).alias(name) if name == text_column else column(name)
        for name in docs.columns
    ]
    if lines_column:
        n_lines = F.when(text.isNull(), 0).otherwise(F.size(F.split(text, "\n", -1)))
        names.append(n_lines.cast("bigint").alias(lines_column))
    if removed_column:
        n_removed = F.when(removed.isNull(), 0).otherwise(F.size(removed))
        names.append(n_removed.cast("bigint").alias(removed_column))
    return joined.select(*names)
