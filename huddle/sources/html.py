"""HTML tables as DataFrames: header labels and body rows of the first
matching container of every page, extracted with JVM array functions on the
``html`` column (no DOM parser, no Python per row).

A block runs from its opening tag to the closing one of the same depth: what
a nested table (or list) holds belongs to the cell (or item) around it.  A row
or cell without a closing tag ends where the next one begins or its table
ends.  Cell text has inner tags removed, the common and the numeric character
entities decoded and surrounding white space (line breaks and no-break spaces
too) removed.  Tags match in either case.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Group labels dropped from a table header (fixed values).
GROUP_LABELS = ["", "Rushing", "Passing", "Receiving", "Fantasy", "Fantasy per Game"]

# Entities decoded in cell text (fixed values), applied in this order.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&nbsp;", " "), ("&amp;", "&")]


def first_block(html: Column, tag: str) -> Column:
    """Inner HTML of the first ``tag`` block (empty string if none)."""
    return F.coalesce(F.try_element_at(all_blocks(html, tag), F.lit(1)), F.lit(""))


def _scope(tag: str) -> str:
    """The tags that nest: what lies inside one belongs to the block around it."""
    if re.match(r"t(?:r|d|h|\[|head|body)", tag):
        return "table"
    if tag in ("ul", "ol", "li"):
        return "ul|ol"
    return tag if tag in ("table", "div", "span", "section") else "(?!)"


def all_blocks(html: Column, tag: str) -> Column:
    """Inner HTML of every outermost block of ``tag`` (a pattern of tag names)."""
    scope = _scope(tag)
    nests = tag in scope.split("|")  # then an inner opening tag deepens, else it begins the next block
    pieces = F.split(F.coalesce(html, F.lit("")), rf"(?i)(?=</?(?:{scope}|{tag})(?=[\s/>]))")

    def merge(state: Column, piece: Column) -> Column:
        def to(depth, text, out):
            return F.struct(depth.cast("int").alias("depth"), text.cast("string").alias("text"), out.alias("out"))

        is_ = lambda name, end="": piece.rlike(rf"(?i)^<{end}(?:{name})[\s/>]")
        depth, text, out = state["depth"], state["text"], state["out"]
        inner = F.regexp_replace(piece, r"^<[^>]*>", "")
        more, done = F.concat(text, piece), F.concat(out, F.array(text))
        closed, open_ = depth == 0, depth == 1  # deeper: inside a nested scope
        enter = to(F.lit(1), inner, out)
        begins_next = F.lit(False) if nests else is_(tag) & open_
        return (
            F.when(closed, F.when(is_(tag), enter).otherwise(state))
            .when(begins_next, to(F.lit(1), inner, done))
            .when((is_(tag, "/") if not nests else is_(scope, "/")) & open_, to(F.lit(0), F.lit(""), done))
            .when(is_(scope), to(depth + 1, more, out))
            .when(is_(scope, "/"), F.when(open_, to(F.lit(0), F.lit(""), done)).otherwise(to(depth - 1, more, out)))
            .otherwise(to(depth, more, out))
        )

    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("text"), F.array().cast("array<string>").alias("out"))
    return F.aggregate(pieces, start, merge, lambda s: F.when(s["depth"] > 0, F.concat(s["out"], F.array(s["text"]))).otherwise(s["out"]))


def clean_text(c: Column) -> Column:
    text = F.regexp_replace(c, r"<[^>]*>", "")
    text = decode_numbers(text)
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.regexp_replace(text, r"^[\s\u00a0]+|[\s\u00a0]+$", "")


def decode_numbers(text: Column) -> Column:
    """Decimal and hexadecimal character references; one that names no character stays as it is."""

    def char(ref: Column) -> Column:
        digits = F.regexp_extract(ref, r"(?i)^&#x?([0-9a-f]+);$", 1)
        code = F.when(F.lower(F.substring(ref, 3, 1)) == "x", F.conv(digits, 16, 10)).otherwise(digits).try_cast("int")
        real = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        found = F.decode(F.unhex(F.lpad(F.hex(F.when(real, code).otherwise(63)), 8, "0")), "UTF-32")
        # an ampersand waits for the named entities, so that what it yields is not read again
        return F.when(real, F.when(found == "&", "&amp;").otherwise(found)).otherwise(ref)

    refs = F.array_distinct(F.regexp_extract_all(text, F.lit(r"(?i)(&#(?:[0-9]{1,7}|x[0-9a-f]{1,6});)"), F.lit(1)))
    return F.aggregate(refs, text, lambda done, r: F.replace(done, r, char(r)))


def header_labels(pages: DataFrame, drop: Sequence[str] = GROUP_LABELS, html: str = "html") -> DataFrame:
    """(page_id, headers): texts of the ``th`` cells of the first ``thead``,
    without the group labels (every occurrence of a kept label stays)."""
    cells = F.transform(all_blocks(first_block(F.col(html), "thead"), "th"), clean_text)
    kept = F.filter(cells, lambda h: ~h.isin(*drop)) if drop else cells
    return pages.select("page_id", kept.alias("headers"))


def body_rows(
    pages: DataFrame,
    container: str = "tbody",
    row_tag: str = "tr",
    cell_tags: str = "t[hd]",
    html: str = "html",
    dedupe: bool = True,
) -> DataFrame:
    """(page_id, row_index, cells): one row per row of the first
    ``container`` of each page, cells in document order.  With ``dedupe``
    repeated rows of a page are kept once (at their first position)."""
    rows = all_blocks(first_block(F.col(html), container), row_tag)
    exploded = pages.select("page_id", F.posexplode(rows).alias("row_index", "_row"))
    cells = F.transform(all_blocks(F.col("_row"), cell_tags), clean_text)
    out = exploded.select("page_id", "row_index", cells.alias("cells"))
    if dedupe:
        out = out.groupBy("page_id", "cells").agg(F.min("row_index").alias("row_index"))
        out = out.select("page_id", "row_index", "cells")
    return out


def nth_position(labels: Column, label: str, n: int) -> Column:
    """0-based position of the n-th (1-based) occurrence of ``label``."""
    hits = F.filter(F.transform(labels, lambda h, i: F.when(h == label, i)), lambda i: i.isNotNull())
    return F.try_element_at(hits, F.lit(n))


def position_table(
    pages: DataFrame,
    season: str = "season",
    position: str = "position",
    key_label: str = "Tm",
    value_label: str = "FantPt",
    occurrence: int = 2,
    html: str = "html",
) -> DataFrame:
    """(Tm, Season, position, value, occurrence) from pages holding one table each,
    ``occurrence`` counting a team's rows on its pages from 1, with ``season`` and ``position`` columns on the page row.  The value is
    the ``occurrence``-th column labelled ``value_label`` (the per-game
    figure), cast to double (non-numbers become NULL).  Pages whose header
    lacks that occurrence contribute nothing.

    One projection per page yields its header positions and body rows
    together, so the page text is read once (no join of header, rows and
    page metadata); repeated rows of a page are kept once.
    """
    page = F.col(html)
    headers = F.transform(all_blocks(first_block(page, "thead"), "th"), clean_text)
    headers = F.filter(headers, lambda h: ~h.isin(*GROUP_LABELS))
    per_page = pages.select(
        "page_id",
        F.col(season).cast("int").alias("Season"),
        F.col(position).alias("position"),
        nth_position(headers, key_label, 1).alias("_kp"),
        nth_position(headers, value_label, occurrence).alias("_vp"),
        all_blocks(first_block(page, "tbody"), "tr").alias("_rows"),
    ).filter(F.col("_kp").isNotNull() & F.col("_vp").isNotNull())
    rows = per_page.select(
        "page_id", "Season", "position", "_kp", "_vp",
        F.posexplode(F.transform("_rows", lambda r: F.transform(all_blocks(r, "t[hd]"), clean_text))).alias("_at", "cells"),
    )
    rows = rows.groupBy("page_id", "Season", "position", "_kp", "_vp", "cells").agg(F.min("_at").alias("_at"))
    rows = rows.select(
        F.try_element_at("cells", F.col("_kp") + 1).alias("Tm"),
        "Season",
        "position",
        F.try_element_at("cells", F.col("_vp") + 1).try_cast("double").alias("value"),
        "page_id",
        "_at",
    )
    nth = F.row_number().over(Window.partitionBy("Tm", "Season", "position").orderBy("page_id", "_at"))
    return rows.select("Tm", "Season", "position", "value", nth.alias("occurrence"))


def defense_points_table(
    pages: DataFrame,
    positions: Sequence[str] = ("RB", "TE", "WR", "QB"),
    season: str = "season",
    position: str = "position",
) -> DataFrame:
    """(Tm, Season, '<pos> FantPt' for each position) from one page per
    (season, position): the per-game points column of every page, one row
    per team and season.  A team missing from one position's page gets NULL
    there (the outer merge of the per-position tables, as one pivot).  A team
    that a page lists several times keeps all its rows: its n-th row of one
    position meets its n-th of the others."""
    from huddle.operators.tables import pivot_positions

    rows = position_table(pages, season=season, position=position)
    return pivot_positions(rows, ["Tm", "Season", "occurrence"], "position", "value", list(positions), name="{p} FantPt").drop("occurrence")
