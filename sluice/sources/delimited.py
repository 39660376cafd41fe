"""Delimited files of any size and make: lines are read in parallel, and what a quote opens is told by a scan over the lines' effects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.functions.ranks import bucketed_sums
from sluice.functions.staging import bounded_broadcast, staged

DELIMITERS = (",", ";", "\t", "|")
#: Rows without blank ones in which a header is looked for.
HEADER_ROWS = 8
SPACE = " \t\r\n\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"
# What Windows-1252 has in place of the control characters from 0x80 on; five places are empty.
CP1252 = "€\x81‚ƒ„…†‡ˆ‰Š‹Œ\x8dŽ\x8f\x90‘’“”•–—˜™š›œ\x9džŸ"
#: States within a line: at the start of a cell, in one without quotes, in a quoted one, behind a quote in a quoted one.
START, PLAIN, QUOTED, BEHIND = range(4)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """path, block, at, value (bytes) of every line: block is the place of the part of the file that a task read, at the order in it."""
    rows = spark.read.option("lineSep", "\n").text(path)
    rows = rows.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.col("value").cast("binary").alias("value"))
    return staged(rows, "delimited-lines")


def _decoded(lines: DataFrame) -> DataFrame:
    """lines with value as text: UTF-8 if all of the file is, else Windows-1252, or Latin-1 if a byte is none of that; a mark of byte order goes."""
    odd = F.decode("value", "ISO-8859-1").rlike("[\x81\x8d\x8f\x90\x9d]")
    kinds = lines.groupBy(F.col("path").alias("_p")).agg(F.bool_and(F.is_valid_utf8(F.col("value").cast("string"))).alias("_utf8"), F.bool_or(odd).alias("_latin"), F.min(F.struct("block", "at")).alias("_top"))
    kinds = bounded_broadcast(staged(kinds, "delimited-kinds"))
    latin = F.decode("value", "ISO-8859-1")
    text = F.when(F.col("_utf8"), F.col("value").cast("string")).when(F.col("_latin"), latin).otherwise(F.translate(latin, "".join(map(chr, range(0x80, 0xA0))), CP1252))
    first = (F.col("block") == F.col("_top.block")) & (F.col("at") == F.col("_top.at"))
    text = F.when(first & text.startswith("﻿"), F.substr(text, F.lit(2))).otherwise(text)
    return lines.join(kinds, lines["path"] == kinds["_p"]).select("path", "block", "at", text.alias("value"), first.alias("first"))


def delimiter_of(line: Column) -> Column:
    """The delimiter that a file's first line has most of outside quotes; of equal ones the comma, then the first of DELIMITERS."""
    plain = F.regexp_replace(line, '"[^"]*"?', "")
    counts = F.array(*[F.struct((F.length(plain) - F.length(F.replace(plain, F.lit(d)))).alias("n"), F.lit(-i).alias("i"), F.lit(d).alias("d")) for i, d in enumerate(DELIMITERS)])
    return F.array_max(counts)["d"]


def _after(state: Column, part: Column, delimiter: Column) -> Column:
    """The state after a part of a line without quotes."""
    return F.when((state == QUOTED) | (part == ""), state).when(part.endswith(delimiter), START).otherwise(PLAIN)


def _quote(state: Column) -> Column:
    """The state after a quote."""
    return F.when(state.isin(START, BEHIND), QUOTED).when(state == QUOTED, BEHIND).otherwise(state)


def ends_quoted(line: Column, delimiter: Column, start: int) -> Column:
    """Whether the line ends in an open quoted cell if it begins in state `start`."""
    parts = F.split(line, '"')
    step = lambda s, p: _after(_quote(s), p, delimiter)
    first = _after(F.lit(start), F.get(parts, F.lit(0)), delimiter)
    end = F.aggregate(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), first.cast("int"), lambda s, p: step(s, p).cast("int"))
    return F.when(F.contains(line, F.lit('"')), end == QUOTED).otherwise(F.lit(start == QUOTED))


def _records(lines: DataFrame) -> DataFrame:
    """path, block, at (of its first line), record (number in the file, from 0), delimiter, value of every record.

    Each line maps the state before it, in a quoted cell or not, to the one after it. A line that ends alike from either state
    sets it, one that turns it counts as a turn; so the state before a line is what the last setting line left, turned as
    often as there were turns since. Both come from sums over a block and the blocks before it, a row for each.
    """
    delimiters = lines.filter("first").select(F.col("path").alias("_p"), delimiter_of(F.col("value")).alias("delimiter"))
    delimiters = bounded_broadcast(staged(delimiters, "delimited-delimiters"))
    d = F.col("delimiter")
    rows = lines.join(delimiters, lines["path"] == delimiters["_p"]).select("path", "block", "at", "value", "delimiter", ends_quoted(F.col("value"), d, START).alias("_out"), ends_quoted(F.col("value"), d, QUOTED).alias("_in"))
    rows = rows.withColumn("_turn", (F.col("_out") & ~F.col("_in")).cast("int"))
    rows = staged(bucketed_sums(rows, ["path"], ["block"], ["at"], F.col("_turn"), "_turns"), "delimited-turns")
    parity = lambda n: n.bitwiseAND(F.lit(1)) == 1
    rows = rows.withColumn("_set", F.when(F.col("_out") == F.col("_in"), F.col("_out") != parity(F.col("_turns"))))
    within = Window.partitionBy("path", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("path", "block").agg(F.max_by("_set", F.when(F.col("_set").isNotNull(), F.col("at"))).alias("_last"))
    carried = blocks.select(F.col("path").alias("_cp"), F.col("block").alias("_cb"), F.last("_last", ignorenulls=True).over(Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)).alias("_before"))
    rows = rows.withColumn("_own", F.last("_set", ignorenulls=True).over(within))
    rows = rows.join(carried, (rows["path"] == carried["_cp"]) & (rows["block"] == carried["_cb"]))
    inside = F.coalesce("_own", "_before", F.lit(False)) != parity(F.col("_turns"))
    rows = rows.select("path", "block", "at", "value", "delimiter", "_out", inside.alias("_inside")).withColumn("_starts", (~F.col("_inside")).cast("int"))
    rows = bucketed_sums(rows, ["path"], ["block"], ["at"], F.col("_starts"), "_before").withColumn("record", F.col("_before") + F.col("_starts") - 1)
    rows = staged(rows.select("path", "block", "at", "value", "delimiter", (~F.col("_inside") & ~F.col("_out")).alias("_whole"), "record"), "delimited-numbered")
    parts = rows.filter("NOT _whole").groupBy("path", "record", "delimiter").agg(F.sort_array(F.collect_list(F.struct("block", "at", "value"))).alias("_parts"))
    joined = parts.select("path", F.get("_parts", F.lit(0))["block"].alias("block"), F.get("_parts", F.lit(0))["at"].alias("at"), F.array_join(F.transform("_parts", lambda p: p["value"]), "\n").alias("value"), "delimiter", "record")
    return rows.filter("_whole").select(*joined.columns).unionByName(joined)


def cells_of(value: Column, delimiter: Column) -> Column:
    """The cells of a record, trimmed, null where nothing is left: a fold over what its quotes part."""
    pattern = F.when(delimiter == "|", r"\|").otherwise(delimiter)
    state = "struct<cells:array<string>,cell:string,at:int>"
    parts = F.split(value, '"')

    def text(s: Column, p: Column) -> Column:
        cut = F.split(p, pattern)
        n = F.size(cut)
        new = F.struct(F.concat(s["cells"], F.array(F.concat(s["cell"], F.get(cut, F.lit(0)))), F.slice(cut, F.lit(2), F.greatest(n - 2, F.lit(0)))).alias("cells"), F.element_at(cut, -1).alias("cell"), _after(s["at"], p, delimiter).cast("int").alias("at"))
        longer = F.struct(s["cells"].alias("cells"), F.concat(s["cell"], p).alias("cell"), _after(s["at"], p, delimiter).cast("int").alias("at"))
        return F.when((s["at"] == QUOTED) | (n < 2), longer.cast(state)).otherwise(new.cast(state))

    def quote(s: Column) -> Column:
        kept = s["at"].isin(PLAIN, BEHIND)
        return F.struct(s["cells"].alias("cells"), F.when(kept, F.concat(s["cell"], F.lit('"'))).otherwise(s["cell"]).alias("cell"), _quote(s["at"]).cast("int").alias("at")).cast(state)

    none = F.struct(F.array().cast("array<string>").alias("cells"), F.lit("").alias("cell"), F.lit(START).alias("at")).cast(state)
    first = text(none, F.get(parts, F.lit(0)))
    end = F.aggregate(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), first, lambda s, p: text(quote(s), p), lambda s: F.concat(s["cells"], F.array(s["cell"])))
    cells = F.when(F.contains(value, F.lit('"')), end).otherwise(F.split(value, pattern))
    return F.transform(cells, lambda c: F.nullif(F.trim(c, F.lit(SPACE)), F.lit("")))


def _headers(rows: DataFrame) -> DataFrame:
    """path, names, top (the header's record, or the one before the first row of data), end (the last record that was looked at), seen (rows of data up to it).

    The header is the first of HEADER_ROWS rows with two cells, else the first; a row of numbers alone is data, and columns are then numbered.
    """
    w = Window.partitionBy("path", "block").orderBy("record")
    first = rows.filter("filled > 0").withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= HEADER_ROWS)
    row = F.struct("record", "filled", "cells")
    top = first.groupBy("path").agg(F.slice(F.sort_array(F.collect_list(row)), 1, HEADER_ROWS).alias("_rows"))  # HEADER_ROWS a block at most
    at = F.coalesce(F.array_position(F.transform("_rows", lambda r: r["filled"] >= 2), True), F.lit(0)).cast("int")
    top = top.withColumn("_i", F.greatest(at - 1, F.lit(0))).withColumn("_head", F.get("_rows", F.col("_i")))
    filled = F.array_compact("_head.cells")
    numbers = (F.size(filled) > 1) & F.forall(filled, lambda c: c.rlike(r"^[\d.,+\-]+$"))
    last = F.array_max(F.transform("_head.cells", lambda c, i: F.when(c.isNotNull(), i + 1)))
    base = F.transform(F.slice("_head.cells", F.lit(1), last), lambda c, i: F.when(c.isNull() | F.col("_numbers"), F.format_string("col_%d", i + 1)).otherwise(c))
    top = top.withColumn("_numbers", numbers).withColumn("_base", base)
    same = lambda c, i: F.size(F.filter(F.slice("_base", F.lit(1), i + 1), lambda x: x == c))
    names = F.transform("_base", lambda c, i: F.when(same(c, i) == 1, c).otherwise(F.format_string("%s__%d", c, same(c, i))))
    data = F.col("_i") + F.when(F.col("_numbers"), 0).otherwise(1)
    return top.select(F.col("path").alias("_p"), names.alias("names"), (F.col("_head.record") - F.when(F.col("_numbers"), 1).otherwise(0)).alias("top"), F.element_at("_rows", -1)["record"].alias("end"), (F.size("_rows") - data).alias("seen"), F.transform(F.slice("_rows", data + 1, F.greatest(F.size("_rows") - data, F.lit(0))), lambda r: r["record"]).alias("early"))


def read_delimited(spark: SparkSession, path: str) -> DataFrame:
    """path, row_number, cells (by column name) of the rows with a filled cell of every delimited file at `path`.

    Encoding and delimiter are found for each file (`_decoded`, `delimiter_of`), titles above the header are skipped, names are made
    unique (name__2), columns without a name are col_n, as are cells beyond the header. Quoted cells may hold delimiters, doubled
    quotes and line ends; a quote within a cell that doesn't begin with one is a character. row_number counts rows of data, and blank
    ones among them behind the first rows. A file is read by as many tasks as it has blocks, since the state at a block's start comes
    from a scan (`_records`); only cells over several lines are put together by a shuffle. A quote that nothing closes makes one
    record of the rest of its file. A file without a filled cell has no rows.
    """
    rows = _records(_decoded(_lines(spark, path)))
    rows = rows.select("path", "block", "record", cells_of(F.col("value"), F.col("delimiter")).alias("cells"))
    rows = staged(rows.withColumn("filled", F.size(F.array_compact("cells"))), "delimited-records")
    headers = bounded_broadcast(staged(_headers(rows), "delimited-headers"))
    rows = rows.filter("filled > 0").join(headers, rows["path"] == headers["_p"]).filter(F.col("record") > F.col("top"))
    number = F.when(F.col("record") <= F.col("end"), F.array_position("early", F.col("record"))).otherwise(F.col("seen") + F.col("record") - F.col("end"))
    pairs = F.filter(F.transform("cells", lambda c, i: F.struct(F.coalesce(F.get("names", i), F.format_string("col_%d", i + 1)).alias("key"), c.alias("value"))), lambda e: e["value"].isNotNull())
    keyed = rows.select("path", number.cast("int").alias("row_number"), pairs.alias("_pairs")).withColumn("_keys", F.reverse(F.transform("_pairs", lambda e: e["key"])))
    last = F.filter("_pairs", lambda e, i: F.array_position("_keys", e["key"]) == F.size("_pairs") - i)  # of equal names the last cell
    return keyed.select("path", "row_number", F.map_from_entries(last).alias("cells"))
