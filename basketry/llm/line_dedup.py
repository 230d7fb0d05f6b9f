"""Line dedup with a segment-partition edit join.

Equal lines are one line from the start (128-bit keys, first occurrence, count).  Distinct lines
of at least ``MIN_CHARS`` characters are linked if their edit distance is at most
``EDITS``.  A line is cut into EDITS + 1 segments; at most EDITS edits leave one of them
intact in the other line, near its place.  So each line is indexed by (length, segment number,
segment) and probes the indexes of its own length and the EDITS shorter ones with
the substrings that the multi-match-aware rule selects.  Candidate
pairs are verified with a banded bit-parallel edit distance.

Lines that share a segment are compared by a signature of letter counts inside the join already (an edit changes the
counts by two at most), so that a group of lines that merely share a passage, or are copies with other words
exchanged, yields hardly a row.  A segment that more than ``HOT`` lines share isn't compared at once: the segment is cut out of
its lines, and what is left of them (still within EDITS edits for linked lines) is
joined the same way inside that segment's group, level by level, so that pairs come only from lines
that agree in several places.

DataFrame functions only.  Line texts aren't shuffled: key rows are two longs, and per-document flags
are joined to the documents by broadcast up to a checked size, else by a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import SPACES, materialize, read_table, small_side
from basketry.llm.graph import connected_components

EDITS, MIN_CHARS = 2, 32
#: Lines that may share one segment key before it is cut finer, and characters of remainder that are no longer cut.
HOT, LEAST_CUT = 2048, 9
#: Letters that a line's signature counts (frequent ones, as they tell most), four bits each.
COUNTED = "etaoinsrhldcumgp"


def edit_distance(a: Column, b: Column, edits: int = EDITS) -> Column:
    """Edit distance of two arrays of characters, ``edits + 1`` if it is more than ``edits``.

    Bit d + edits of register e says: with at most e edits, the characters of ``b`` read so far match d
    more characters of ``a``.  One step a character, 2 * edits + 1 diagonals at once."""
    band = (1 << (2 * edits + 1)) - 1
    registers = [F.lit(((1 << (e + 1)) - 1) << edits & band) for e in range(edits + 1)]

    def step(state: Column, j: Column) -> Column:
        own = F.get(b, j)
        match = F.lit(0)
        for d in range(-edits, edits + 1):
            same = F.coalesce(F.get(a, F.greatest(j + d, F.lit(0))) == own, F.lit(False)) & (j + d >= 0)
            match = match.bitwiseOR(F.when(same, F.lit(1 << (d + edits))).otherwise(F.lit(0)))
        new = [state["r0"].bitwiseAND(match)]
        for e in range(1, edits + 1):
            before = state[f"r{e - 1}"]
            by_edit = before.bitwiseOR(F.shiftright(before, 1)).bitwiseOR(F.shiftleft(new[e - 1], 1))
            new.append(state[f"r{e}"].bitwiseAND(match).bitwiseOR(by_edit).bitwiseAND(F.lit(band)))
        return F.struct(*[x.alias(f"r{e}") for e, x in enumerate(new)])

    def result(state: Column) -> Column:
        out = F.lit(edits + 1)
        for e in range(edits, -1, -1):
            out = F.when(F.call_function("shiftright", state[f"r{e}"], F.size(a) - F.size(b) + edits).bitwiseAND(F.lit(1)) == 1, e).otherwise(out)
        return out

    start = F.struct(*[x.cast("int").alias(f"r{e}") for e, x in enumerate(registers)])
    steps = F.when(F.size(b) > 0, F.sequence(F.lit(0), F.size(b) - 1)).otherwise(F.array().cast("array<int>"))
    near = F.abs(F.size(a) - F.size(b)) <= edits
    return F.when(near, F.aggregate(steps, start, step, result)).otherwise(edits + 1)


def selections(edits: int = EDITS) -> list[tuple[int, int, int, bool]]:
    """``(length difference, segment, shift, is_index)``: the substrings a line probes with; its own segments come first."""
    out = []
    for less in range(edits + 1):
        for i in range(edits + 1):
            lo, hi = max(-i, less - (edits - i)), min(i, less + (edits - i))
            out += [(less, i, shift, less == 0 and shift == 0) for shift in range(lo, hi + 1)]
    return out


def letter_counts(s: Column) -> Column:
    """How often a line holds each letter of ``COUNTED``, modulo 16, packed in a long."""
    out = F.lit(0).cast("long")
    for i, c in enumerate(COUNTED):
        held = (F.length(s) - F.length(F.replace(s, F.lit(c), F.lit("")))).cast("long")
        out = out.bitwiseOR(F.shiftleft(held.bitwiseAND(F.lit(15)), 4 * i))
    return out


def counts_differ(a: Column, b: Column) -> Column:
    """By how much two signatures differ: never more than twice the edit distance."""
    total = F.lit(0).cast("long")
    for i in range(len(COUNTED)):
        x, y = (F.shiftright(c, 4 * i).bitwiseAND(F.lit(15)) for c in (a, b))
        total = total + F.least(F.abs(x - y), 16 - F.abs(x - y))
    return total


def segment_keys(lines: DataFrame, edits: int = EDITS) -> DataFrame:
    """``line, key, at, width, is_index, even``: one row for each selected substring of ``lines`` (``line, scope, s``);
    ``even``: for lines of the same length.

    ``scope`` keeps groups apart; ``at`` and ``width`` are the place of the substring."""
    parts = edits + 1
    fields = ("less", "part", "shift", "is_index")
    table = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(fields, x, strict=True)]) for x in selections(edits)])
    rows = lines.withColumn("x", F.explode(table)).select("*", "x.*")
    rows = rows.withColumn("n", F.length("s")).withColumn("length", F.col("n") - F.col("less")).where("length >= 0")
    rows = rows.withColumn("base", F.expr(f"length div {parts}").cast("int")).withColumn("short", F.expr(f"{parts} - length % {parts}").cast("int"))
    rows = rows.withColumn("width", F.expr("base + if(part >= short, 1, 0)"))
    rows = rows.withColumn("at", F.expr("part * base + greatest(0, part - short) + shift")).where("at >= 0 and at + width <= n")
    key = F.xxhash64("scope", "length", "part", F.expr("substring(s, at + 1, width)"))
    return rows.select("line", key.alias("key"), "at", "width", "is_index", (F.col("less") == 0).alias("even"), "s")


def candidate_links(lines: DataFrame, edits: int = EDITS, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """``(pairs, held)``: distinct pairs ``a, b`` (a < b) of ``lines`` (``line, s``, maybe more) that share a segment and
    letters as linked lines must, and the lines that share any segment, with their letter ``counts``.

    Keys that one line alone has are dropped by a grouping with partial sums before lines meet. The loop ends because
    every level cuts a third of the text away; below ``LEAST_CUT`` characters the group is joined as it is."""
    level, found, held, first = lines.withColumn("scope", F.lit(0).cast("long")), None, None, True
    while True:
        all_keys = segment_keys(level.select("line", "scope", "s"), edits)
        cuttable = (F.length("s") - F.col("width") >= LEAST_CUT).alias("cuttable")
        keys = materialize(all_keys.select("line", "key", "is_index", "even", cuttable), "lines-keys")
        lines_of_key = keys.groupBy("key").agg(
            F.min("line").alias("least"), F.max("line").alias("most"), F.count_if("is_index").alias("held_by"), F.count_if(F.col("is_index") & F.col("cuttable")).alias("cut_by")
        )
        shared = materialize(lines_of_key.where("least <> most and held_by > 0").select("key", (F.col("cut_by") > hot).alias("crowded")), "lines-shared")
        rows = materialize(keys.join(small_side(shared, 24), "key"), "lines-meeting")
        if held is None:
            meeting = materialize(rows.select("line").distinct(), "lines-wanted")
            held = lines.join(small_side(meeting, 16), "line").dropDuplicates()
            held = materialize(held.withColumn("counts", letter_counts(F.col("s"))), "lines-held")
        counted = held.select("line", "counts").dropDuplicates()
        meet = rows.where("not crowded").join(counted, "line")
        own = meet.where("is_index").select(F.col("line").alias("a"), "key", "counts")
        probes = meet.select(F.col("line").alias("b"), F.col("key").alias("b_key"), F.col("counts").alias("b_counts"), "even")
        # Lines of one length meet in both directions; one is enough.
        other = F.when(F.col("even"), F.col("a") < F.col("b")).otherwise(F.col("a") != F.col("b"))
        near = (F.col("key") == F.col("b_key")) & other & (counts_differ(F.col("counts"), F.col("b_counts")) <= 2 * edits)
        pairs = own.join(probes, near).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        pairs = materialize(pairs, "lines-candidates")
        found = pairs if found is None else found.union(pairs)
        crowded = materialize(shared.where("crowded").select("key"), "lines-crowded")
        if crowded.isEmpty():
            return found.distinct(), held
        left = F.expr("concat(substring(s, 1, at), substring(s, at + width + 1))").alias("s")
        # Crowded lines share keys, so the lines held are enough.
        cut = segment_keys(held.withColumn("scope", F.lit(0).cast("long")) if first else level, edits).join(small_side(crowded, 16), "key")
        level, first = materialize(cut.select("line", F.col("key").alias("scope"), left).distinct(), "lines-level"), False


def may_be_near(a: Column, b: Column, edits: int = EDITS, pieces: int = 8) -> Column:
    """Whether two lines can be within ``edits``: an edit spoils at most one of ``pieces`` equal pieces of ``a``;
    the others lie in ``b`` at most ``edits`` characters from their place."""
    width = F.floor(F.length(a) / pieces).cast("int")
    held = F.lit(0)
    for i in range(pieces):
        at = width * i
        near = F.substring(b, F.greatest(at - edits, F.lit(0)) + 1, width + 2 * edits)
        held = held + F.contains(near, F.substring(a, at + 1, width)).cast("int")
    return held >= pieces - edits


def common_prefix(a: Column, b: Column) -> Column:
    """Characters (up to 2**21) that two texts have in common at their start, by bisection."""
    least = F.least(F.length(a), F.length(b))
    steps = F.array(*[F.lit(1 << i) for i in range(20, -1, -1)])

    def grow(n: Column, step: Column) -> Column:
        return F.when((n + step <= least) & (F.substring(a, n + 1, step) == F.substring(b, n + 1, step)), n + step).otherwise(n)

    return F.aggregate(steps, F.lit(0), grow)


def middles(pairs: DataFrame) -> DataFrame:
    """``a_key, b_key, a_chars, b_chars``: the lines without their common start and end, whose edit distance is the lines' own."""
    cut = pairs.withColumn("head", common_prefix(F.col("a_text"), F.col("b_text"))).withColumn("tail", common_prefix(F.col("a_back"), F.col("b_back")))
    tail = F.least("tail", F.least(F.length("a_text"), F.length("b_text")) - F.col("head"))
    left = [F.substring(c, F.col("head") + 1, F.length(c) - F.col("head") - tail) for c in (F.col("a_text"), F.col("b_text"))]
    chars = [F.when(x == "", F.array().cast("array<string>")).otherwise(F.split(x, "")).alias(n) for x, n in zip(left, ("a_chars", "b_chars"), strict=True)]
    return cut.select("a_key", "b_key", *chars)


def has_word(text: Column) -> Column:
    return F.ltrim(text, F.lit(SPACES)) != ""


def split_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with ``lines``: the text cut at line feeds (null: no lines)."""
    return docs.withColumn("lines", F.when(F.col("text").isNotNull(), F.split("text", "\n")).otherwise(F.array().cast("array<string>")))


def lines_without(gone: str) -> Column:
    """``lines`` without the places in the sorted array ``gone`` (null: none): runs between them, linear in the lines."""
    bounds = F.concat(F.array(F.lit(-1)), gone, F.array(F.size("lines")))
    runs = F.transform(
        F.sequence(F.lit(0), F.size(gone)),
        lambda i: F.slice("lines", F.get(bounds, i) + 2, F.greatest(F.get(bounds, i + 1) - F.get(bounds, i) - 1, F.lit(0))),
    )
    return F.when(F.coalesce(F.size(gone) > 0, F.lit(False)), F.flatten(runs)).otherwise(F.col("lines"))


def join_rows(texts: DataFrame, found: DataFrame, row_bytes: int, how: str = "left") -> DataFrame:
    """What was found for a row (``doc_id, t``), joined to the rows; ids may be null or repeated."""
    found = found.withColumnRenamed("doc_id", "found_id").withColumnRenamed("t", "found_t")
    return texts.join(small_side(found, row_bytes), F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("t") == F.col("found_t")), how)


def line_classes(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS) -> tuple[DataFrame, DataFrame]:
    """``(occurrences, classes)`` of the lines of ``docs`` (``doc_id, text``).

    ``occurrences``: ``doc_id, t`` (hash of the text), ``pos, k1, k2, n`` for every line, keys null for lines without a word.
    ``classes``: ``k1, k2, first`` (struct of doc_id and pos), ``n_occurrences, class_first, class_size, n_links`` for every distinct line with a word."""
    bare = docs.select("doc_id", "text", F.xxhash64("text").alias("t"))
    texts = split_lines(bare)
    worded = has_word(F.col("line"))
    rows = texts.select("doc_id", "t", F.posexplode("lines").alias("pos", "line"))
    keys = [F.when(worded, F.xxhash64("line")).alias("k1"), F.when(worded, F.xxhash64(F.lit(1), "line")).alias("k2")]
    occurrences = materialize(rows.select("doc_id", "t", "pos", *keys, F.length("line").alias("n")), "lines-occurrences")
    named = occurrences.where("k1 is not null")
    distinct = named.groupBy("k1", "k2", "n").agg(F.min(F.struct("doc_id", "pos")).alias("first"), F.count(F.lit(1)).alias("n_occurrences"))
    distinct = materialize(distinct, "lines-distinct")
    # The first occurrence of each long line, found again in the documents by a flag for each line.
    repeats = distinct.where("n_occurrences > 1").select("k1", "k2", "first")
    not_first = named.where(F.col("n") >= min_chars).join(repeats, ["k1", "k2"]).where(F.struct("doc_id", "pos") != F.col("first"))
    not_first = not_first.groupBy("doc_id", "t").agg(F.array_sort(F.collect_set("pos")).alias("later"))
    with_later = join_rows(texts, materialize(not_first, "lines-later"), 64)
    first_lines = (
        with_later.select(F.explode(lines_without("later")).alias("s"))
        .where((F.length("s") >= min_chars) & has_word(F.col("s")))
        .select(F.xxhash64("s").alias("line"), F.xxhash64(F.lit(1), "s").alias("k2"), "s")
    )
    candidates, held = candidate_links(first_lines, edits)
    candidates = materialize(candidates, "lines-pairs")
    one, two = (held.select(F.col("line").alias(x), F.struct("line", "k2").alias(f"{x}_key"), F.col("s").alias(f"{x}_text")) for x in "ab")
    pairs = candidates.join(one, "a").join(two, "b").where(may_be_near(F.col("a_text"), F.col("b_text"), edits))
    # Verified from columns that were written, dealt over all cores: as expressions, texts would be cut anew at each
    # step of the lambda functions.
    cores = docs.sparkSession.sparkContext.defaultParallelism
    texts_of = ("a_key", "b_key", "a_text", "b_text", F.reverse("a_text").alias("a_back"), F.reverse("b_text").alias("b_back"))
    near = middles(materialize(pairs.select(*texts_of).repartition(4 * cores), "lines-near"))
    near = materialize(near.repartition(4 * cores), "lines-middles")
    close = edit_distance(F.col("a_chars"), F.col("b_chars"), edits) <= edits
    links = near.where(close).select(F.col("a_key").alias("a"), F.col("b_key").alias("b"))
    links = materialize(links, "lines-links")
    firsts = distinct.select(F.struct(F.col("k1").alias("line"), "k2").alias("key"), "first")
    degree = links.select(F.col("a").alias("key")).union(links.select("b")).groupBy("key").agg(F.count(F.lit(1)).alias("n_links"))
    near = links.join(firsts.select(F.col("key").alias("a"), F.col("first").alias("x")), "a").join(firsts.select(F.col("key").alias("b"), F.col("first").alias("y")), "b")
    components = connected_components(near.select("x", "y"), "x", "y").select(F.col("node").alias("first"), F.col("component").alias("class_first"))
    classes = distinct.join(components, "first", "left").withColumn("class_first", F.coalesce("class_first", "first"))
    classes = classes.join(degree.select("key.line", "key.k2", "n_links").withColumnRenamed("line", "k1"), ["k1", "k2"], "left")
    size = classes.where("n_links is not null").groupBy("class_first").agg(F.sum("n_occurrences").alias("class_size"))
    classes = classes.join(size, "class_first", "left").select(
        "k1", "k2", "first", "n_occurrences", "class_first", F.coalesce("class_size", "n_occurrences").alias("class_size"), F.coalesce("n_links", F.lit(0)).alias("n_links")
    )
    return occurrences, materialize(classes, "lines-classes")


def removed_lines(docs: DataFrame, min_repeats: int = 2, edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``row`` (all columns of ``docs``), ``lines, kept_lines, changed, n_exact, n_near, n_links``.

    Lines of classes of at least ``min_repeats`` occurrences go, but for the class's first occurrence (by doc_id, then place).
    ``n_exact`` counts lines that go as equal to an earlier one, ``n_near`` those that only resemble one."""
    occurrences, classes = line_classes(docs, edits, min_chars)
    busy = classes.where(f"n_links > 0 or class_size >= {min_repeats}").drop("n_occurrences")
    told = occurrences.where("k1 is not null").join(busy, ["k1", "k2"])
    here = F.struct("doc_id", "pos")
    told = told.select(
        "doc_id", "t", "pos", "n_links",
        ((F.col("class_size") >= min_repeats) & (here != F.col("class_first"))).alias("gone"), (here != F.col("first")).alias("exact"),
    )
    # Sets, as a row may be repeated.
    by_doc = told.groupBy("doc_id", "t").agg(
        F.array_sort(F.collect_set(F.when(F.col("gone"), F.col("pos")))).alias("gone_at"),
        F.collect_set(F.when(F.col("gone") & ~F.col("exact"), F.col("pos"))).alias("near_at"),
        F.collect_set(F.when(F.col("n_links") > 0, F.struct("pos", "n_links"))).alias("linked"),
    )
    n_links = F.aggregate("linked", F.lit(0).cast("long"), lambda total, x: total + x["n_links"])
    by_doc = by_doc.select(
        "doc_id", "t", "gone_at", (F.size("gone_at") - F.size("near_at")).cast("long").alias("n_exact"), F.size("near_at").cast("long").alias("n_near"), n_links.alias("n_links")
    )
    by_doc = materialize(by_doc, "lines-verdicts")
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text")
    joined = join_rows(split_lines(rows).withColumn("t", F.xxhash64("text")), by_doc, 96)
    some = F.coalesce(F.size("gone_at") > 0, F.lit(False))
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_exact", "n_near", "n_links")]
    return joined.select("row", "lines", lines_without("gone_at").alias("kept_lines"), some.alias("changed"), *zero)


def dedup_lines(docs: DataFrame, min_repeats: int = 2, edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with repeated lines taken out of the texts (``n_chars`` follows if present).

    A document that had words and has none left is dropped; untouched texts stay as they are."""
    out = removed_lines(docs, min_repeats, edits, min_chars).withColumn("left", F.array_join("kept_lines", "\n"))
    row = F.col("row").withField("text", F.col("left"))
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.length("left").cast(docs.schema["n_chars"].dataType))
    out = out.where(~F.col("changed") | has_word(F.col("left")))
    return out.select(F.when(F.col("changed"), row).otherwise(F.col("row")).alias("row")).select("row.*")


def line_report(docs: DataFrame, min_repeats: int = 2, edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row a document: ``doc_id, n_lines`` (with a word), ``n_exact, n_near, n_removed, n_links, kept_sha256``.

    Null texts have no lines (the digest of the empty text); lines without a word stay; null ids come
    first; a row repeated with id and text is one row in the order (both copies keep what it keeps first); an empty
    table gives an empty result; other columns are ignored."""
    out = removed_lines(docs.select("doc_id", "text"), min_repeats, edits, min_chars)
    n_lines = F.size(F.filter("lines", has_word))
    return out.select(
        "row.doc_id", n_lines.cast("long").alias("n_lines"), "n_exact", "n_near", (F.col("n_exact") + F.col("n_near")).alias("n_removed"), "n_links",
        F.sha2(F.array_join("kept_lines", "\n").cast("binary"), 256).alias("kept_sha256"),
    )


def op9_line_dedup(spark, sf_dir: str) -> DataFrame:
    return line_report(read_table(spark, sf_dir, "documents"))
