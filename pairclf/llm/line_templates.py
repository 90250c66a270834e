"""Recurring lines by a log-template tree.

Lines are masked: words with digits are variable fields, unless a line would have few
other words. The tree has a fixed depth: the number of tokens, then the leading tokens.
Within a leaf, lines are generalised: a place of the line
that few of the leaf's distinct lines agree on is a variable field as well, if enough
places, and half of those after the leading ones, are constant. Lines that this does not
fit are split by two of the tokens that they share with others, at a third and two thirds
by frequency, into two groups each, as one may be a field. Each group is generalised by
itself, until no two lines are left together, so a leaf may hold many templates among
other lines. A line takes its template of the most lines.

Two tokens may miss the group that a line fits into, and lines of a group may have fields
in other places. So for each line that ends up alone an exact search by the rarest tokens
(see ``alike``) finds lines of its leaf that agree with it in enough places, if there are
any. Lines alone that were found to agree, also by way of others, are one class; it takes
the template of the most lines among those that any of them was found to agree with, else
one of its own. So each line that agrees with any other shares its template with one that
it agrees with.

A template recurs if it is in two or more distinct texts that are not copies of each
other (``SHORT_TEXTS`` or more, if it has fewer than ``SHORT`` tokens; a line of one
token is no template and stays). Each text that holds a template is compared with the
first one that does; a single text unlike it makes the template recur, so a group of near
copies counts as one text. Two texts are compared by all of their lines, weighed by
tokens. A line has its like in the other text if that has a line of the same template, or
one with the same ``ENDS`` first tokens, ``ENDS`` last tokens or all tokens between those:
two lines that a word was changed in keep one of these in common. Texts are unlike if less
than half of their tokens are in lines that have their like, or if each has ``OWN`` or
more of its tokens in lines that have none: so a passage goes from pages that consist of
it for the most part, while near copies with any edits stay. Of a recurring template the
first occurrence stays, in the text of the least id; all others are dropped.

Null texts stay null, empty texts empty. Copies of a text are one text, and lose the
same lines. Rows without an id come first. Columns other than the text are untouched.
Only DataFrame functions are used; texts move once, when lines are dropped.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F

from ..session import new_table_path, write_table
from .components import components

# White space within a line.
BLANK = r"\x20\x09\x0B-\x0D"
BLANKS = " \t\x0b\x0c\r"
SPACES = f"[{BLANK}]+"
FIELD = "<*>"
#: A token that holds a digit: scanned from its first character, and once.
DIGITS = f"(?<![^{BLANK}])[^{BLANK}0-9]*+[0-9][^{BLANK}]*+"
#: Leading tokens that the tree looks at.
DEPTH = 3
#: Most tokens of a line that is generalised; None: any number.
LOG_TOKENS: int | None = None
#: Templates of fewer tokens need as many texts.
SHORT = 4
SHORT_TEXTS = 10
#: Share of a leaf's distinct lines that agree on a constant, and share of constants.
AGREE = 0.5
CONSTANT = 0.6
#: First and last tokens by which an edited line is known, and its parts; the share of tokens that copies
#: have in common, and of own tokens from which on two texts are unlike all the same.
ENDS = 3
ENDS_AND_BODY = ("head", "body", "tail")
KNOWN_BY = ("template", *ENDS_AND_BODY)
COPY = 0.5
OWN = 0.2
#: Comparisons of lines that stand against one further key that would part them.
DIRECT = 4096


def _texts(documents: DataFrame, text: str, *columns: Column) -> DataFrame:
    """content (hash of the text) and ``columns`` of texts with any line."""
    rows = documents.filter(F.col(text).isNotNull() & (F.col(text) != ""))
    return rows.select(_content(F.col(text)).alias("content"), *columns)


def _content(text: Column) -> Column:
    """What a text is known by, as bytes: half as long to move and to sort as hex digits."""
    return F.unhex(F.md5(text.cast("binary")))


def _words(line: str) -> Column:
    """The words of a line that begins and ends with one. A pattern is compiled anew for each
    line, so it only splits those that have other gaps than single spaces."""
    other_gaps = reduce(or_, [F.col(line).contains(gap) for gap in ("  ", *BLANKS[1:])])
    return F.when(other_gaps, F.split(line, SPACES)).otherwise(F.split(line, " "))


def _with_tokens(each: DataFrame) -> DataFrame:
    """``each`` with size and tokens of the lines ``raw``, masked as a whole and split once;
    blank lines go."""
    raw = F.col("raw")
    # Trimming by a set of characters looks at all of a line; few lines need it.
    indented = reduce(or_, [raw.startswith(blank) | raw.endswith(blank) for blank in BLANKS])
    each = each.withColumn("raw", F.when(indented, F.btrim(raw, F.lit(BLANKS))).otherwise(raw)).filter("raw <> ''")
    with_digits = F.regexp_replace("raw", DIGITS, FIELD)
    each = each.withColumn("masked", F.when(F.col("raw").rlike("[0-9]"), with_digits).otherwise(F.col("raw")))
    each = each.withColumn("tokens", _words("masked")).withColumn("size", F.size("tokens"))
    # A line of fields alone, such as a row of numbers, is no template.
    few = (F.col("masked") != F.col("raw")) & (F.size(F.array_remove("tokens", FIELD)) < CONSTANT * F.col("size"))
    return each.withColumn("tokens", F.when(few, _words("raw")).otherwise(F.col("tokens")))


def _lines(documents: DataFrame, identity: str, text: str) -> DataFrame:
    """content, id, at, size, leaf, line, head, body, tail: a row for each line."""
    rows = _texts(documents, text, F.col(identity).alias("id"), F.split(F.col(text), "\n", -1).alias("lines"))
    # Every text has a line. The outer form adds no filter on that, which would split twice.
    each = _with_tokens(rows.select("content", "id", F.posexplode_outer("lines").alias("at", "raw")))
    return each.select(
        "content", "id", "at", "size",
        F.xxhash64("size", F.slice("tokens", 1, DEPTH)).alias("leaf"),
        F.xxhash64("tokens").alias("line"),
        F.hash(F.slice("tokens", 1, ENDS)).alias("head"),
        F.when(F.col("size") > 2 * ENDS, F.hash(F.slice("tokens", ENDS + 1, F.greatest(F.lit(0), F.col("size") - 2 * ENDS))))
        .otherwise(F.hash("tokens")).alias("body"),
        F.hash(F.slice("tokens", -F.least("size", F.lit(ENDS)), ENDS)).alias("tail"),
    )


def _leaf_lines(lines: DataFrame, documents: DataFrame, text: str) -> DataFrame:
    """leaf, line, tokens: the distinct lines of the leaves that hold several. Their tokens
    are read from one place of each; those of other lines are never held."""
    if LOG_TOKENS is not None:
        lines = lines.filter(F.col("size") <= LOG_TOKENS)
    ends = lines.groupBy("leaf").agg(F.min("line").alias("least"), F.max("line").alias("greatest"))
    leaves = write_table(ends.filter("least <> greatest").select("leaf"), "leaves")
    places = lines.join(leaves, "leaf", "left_semi").groupBy("leaf", "line").agg(F.min(F.struct("content", "at")).alias("place"))
    wanted = places.groupBy(F.col("place.content").alias("content")).agg(
        F.collect_list(F.struct("leaf", "line", F.col("place.at").alias("at"))).alias("wanted")
    )
    wanted = write_table(wanted, "wanted-lines")
    found = _texts(documents, text, F.col(text).alias("text")).join(wanted, "content")
    found = found.select(F.split("text", "\n", -1).alias("lines"), "wanted").select("lines", F.explode("wanted").alias("place"))
    found = found.select("place.leaf", "place.line", F.col("lines")[F.col("place.at")].alias("raw"))
    # Copies of a text give the same line again.
    found = found.groupBy("leaf", "line").agg(F.first("raw").alias("raw"))
    return _with_tokens(found).select("leaf", "line", "tokens")


def of_unlike_texts(inside: DataFrame, once: DataFrame) -> DataFrame:
    """template: those of ``inside`` (template, content, first) that a text holds which
    is no copy of the first text. Pairs of texts are compared once for all templates."""
    pairs = inside.filter("content <> first").groupBy("first", "content").agg(F.collect_set("template").alias("templates"))
    pairs = write_table(pairs, "text-pairs")
    hosts = pairs.select("content").union(pairs.select("first")).distinct()
    # Only lines of the texts of some pair are gathered, each text's into one row. What is
    # looked up stands in columns of the written table, so no look-up makes it anew.
    lines = once.join(hosts, "content", "left_semi").groupBy("content").agg(
        F.collect_list(F.struct(*KNOWN_BY, "size")).alias("lines"),
        F.sum("size").alias("tokens"),
        *[F.collect_set(k).alias(f"any_{k}") for k in KNOWN_BY],
    )
    lines = write_table(lines, "texts-as-lines")
    other = lines.select(*[F.col(c).alias("first" if c == "content" else f"first_{c}") for c in lines.columns])
    both = pairs.join(lines, "content").join(other, "first")

    def own_tokens(lines: str, known: str) -> Column:
        """Tokens of the lines that have no like among what the other text is known by."""

        def unlike(line: Column) -> Column:
            return reduce(and_, [~F.array_contains(F.col(f"{known}any_{k}"), line[k]) for k in KNOWN_BY])

        return F.aggregate(lines, F.lit(0), lambda total, x: total + F.when(unlike(x), x["size"]).otherwise(0))

    sides = both.select(
        "templates", "tokens", "first_tokens",
        own_tokens("lines", "first_").alias("own"), own_tokens("first_lines", "").alias("first_own"),
    )
    like = F.col("tokens") + F.col("first_tokens") - F.col("own") - F.col("first_own")
    unlike = (like < COPY * (F.col("tokens") + F.col("first_tokens"))) | (
        (F.col("own") >= OWN * F.col("tokens")) & (F.col("first_own") >= OWN * F.col("first_tokens"))
    )
    return sides.filter(unlike).select(F.explode("templates").alias("template")).distinct()


def generalised(distinct: DataFrame) -> DataFrame:
    """line, template: for lines that share a template with others. ``distinct`` is
    :func:`_leaf_lines`, so that a line in a third of all texts is one row here."""
    grouped = write_table(distinct.withColumn("group", F.col("leaf")), "template-lines")
    found, of_leaves = [], None
    while True:
        sizes = grouped.groupBy("group").agg(F.count(F.lit(1)).alias("variants"), F.bit_xor("line").alias("members"))
        many = grouped.join(sizes.filter(F.col("variants") >= 2), "group")
        # Groups of the same lines are one.
        many = many.withColumn("group", F.xxhash64("leaf", "variants", "members")).drop("members")
        many = write_table(many.dropDuplicates(["group", "line"]), "template-variants")
        # A split gives every group a token more that all its lines share, so it ends.
        if many.isEmpty():
            break
        # A token in its place of the group is known by a number; it stays with its line.
        places = many.select("group", "line", F.posexplode("tokens").alias("at", "token"))
        places = places.select("group", "line", "at", F.xxhash64("group", "at", "token").alias("place"))
        shared = places.groupBy("place").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= 2)
        shared = places.join(shared, "place").groupBy("group", "line").agg(
            F.sort_array(F.collect_list(F.struct("n", "at"))).alias("shared")
        )
        # Stays a column of the table: an expression would be worked out anew for each token.
        constants = F.filter("shared", lambda c: c["n"] >= F.col("variants") * AGREE)["at"]
        held = F.transform("tokens", lambda token, i: F.when(F.array_contains("constants", i), token).otherwise(FIELD))
        fields = many.join(shared, ["group", "line"]).withColumn("constants", constants).withColumn("held", held)
        size, held_size = F.size("held"), F.size(F.filter("held", lambda t: t != FIELD))
        further = F.size(F.filter(F.slice("held", DEPTH + 1, F.size("held")), lambda t: t != FIELD))
        fits = held_size >= CONSTANT * size
        fits = fits & (2 * further >= size - DEPTH) & (F.col("held") != F.col("tokens"))
        fields = write_table(fields.withColumn("fits", fits), "template-fields")
        of_leaves = fields if of_leaves is None else of_leaves
        found.append(fields.filter("fits").select("line", F.xxhash64("leaf", "held").alias("template")))
        apart = fields.filter("NOT fits").withColumn("apart", F.filter("shared", lambda c: c["n"] < F.col("variants")))
        two = [F.try_element_at("apart", F.ceil(F.size("apart") * k / 3).cast("int")) for k in (1, 2)]
        apart = apart.filter(F.size("apart") > 0).withColumn("by", F.explode(F.array_distinct(F.array(*two))))
        by_token = F.xxhash64("group", "by.at", F.col("tokens")[F.col("by.at")])
        grouped = apart.select("leaf", "line", "tokens", by_token.alias("group"))
    if of_leaves is None:
        return distinct.select("line", F.col("line").alias("template"))
    fitted = write_table(reduce(DataFrame.unionAll, found).distinct(), "fitted-templates")
    sizes = fitted.groupBy("template").agg(F.count(F.lit(1)).alias("n"))
    taken = fitted.join(sizes, "template").groupBy("line").agg(F.max_by("template", F.struct("n", "template")).alias("template"))
    taken = write_table(taken, "taken-templates")
    held_by = taken.groupBy("template").agg(F.count(F.lit(1)).alias("held_by")).filter("held_by >= 2")
    taken = write_table(taken.join(held_by, "template").select("line", "template", "held_by"), "held-templates")
    return taken.select("line", "template").unionByName(_of_lines_alone(of_leaves, taken))


def _of_lines_alone(of_leaves: DataFrame, taken: DataFrame) -> DataFrame:
    """line, template: for the lines without a row in ``taken`` that agree with another line
    of their leaf."""
    leading = F.size(F.filter(F.slice("tokens", 1, DEPTH), lambda t: t != FIELD))
    size = F.size("tokens")
    # Least agreement after the leading tokens, as a fit has it.
    need = F.greatest(F.ceil(CONSTANT * size) - leading, F.ceil((size - DEPTH) / 2)).cast("int")
    token = F.col("tokens")
    after = F.filter("shared", lambda c: (c["at"] >= DEPTH) & (token[c["at"]] != FIELD))
    own = of_leaves.withColumn("after", after).select(
        "leaf", "line", need.alias("need"),
        F.transform("after", lambda c: F.xxhash64(F.col("leaf"), c["at"], token[c["at"]])).alias("places"),
        F.aggregate("after", F.lit(0).cast("bigint"), lambda total, c: total + c["n"]).alias("weight"),
    )
    own = write_table(own.filter("size(places) >= need"), "lines-by-places")
    alone = write_table(own.select("line", "leaf").join(taken, "line", "left_anti"), "lines-alone")
    own = write_table(own.join(alone.select("leaf").distinct(), "leaf", "left_semi"), "lines-to-compare")
    links = alike(own, alone.select("line"))
    offers = links.join(taken.withColumnRenamed("line", "other"), "other").select("line", F.struct("held_by", "template").alias("offer"))
    among = links.join(taken.select(F.col("line").alias("other")), "other", "left_anti")
    classes = components(among.select(F.col("line").alias("a"), F.col("other").alias("b")))
    classes = classes.select(F.col("node").alias("line"), "label")
    rows = offers.unionByName(classes.select("line"), allowMissingColumns=True).groupBy("line").agg(F.max("offer").alias("offer"))
    rows = write_table(rows.join(classes, "line", "left").withColumn("label", F.coalesce("label", "line")), "offered-templates")
    best = rows.groupBy("label").agg(F.max("offer").alias("best"))
    return rows.join(best, "label").select("line", F.coalesce("best.template", "label").alias("template"))


def alike(own: DataFrame, alone: DataFrame) -> DataFrame:
    """line, other: for each line of ``alone`` that shares ``need`` places with any line, links
    from or to it. ``own`` is leaf, line, need (the same within a leaf), places (those that
    most lines lack first, in one order for the leaf) and weight (greater for usual lines).

    First the lines of a leaf are compared with its most usual one. For those still alone:
    of the places that two lines share, the k-th can be followed by ``need - k`` more in
    either line only if it is among the first ``size - need + k``. So they meet in a cell of
    their first shared place, and all lines of the cell are compared. Where that takes more
    than parting them, they are compared with the most usual line of the cell; those still
    alone meet in a cell of the first two shared places, and so on."""
    spark = own.sparkSession
    path = new_table_path(spark, "alike-lines")
    schema = "line bigint, other bigint"
    # Made without Python, of which the executors would start workers for no rows.
    spark.range(0).select(F.col("id").alias("line"), F.col("id").alias("other")).write.parquet(path)
    of_other = own.select(F.col("line").alias("other"), F.col("places").alias("others"))

    def still_alone(pairs: DataFrame, alone: DataFrame) -> DataFrame:
        """``alone`` without the lines that some of the pairs link, which are written."""
        both = pairs.filter("line <> other").distinct().join(own.select("line", "need", "places"), "line").join(of_other, "other")
        same = both.filter(F.size(F.array_intersect("places", "others")) >= F.col("need")).select("line", "other")
        same = write_table(same, "links-of-lines")
        same.write.mode("append").parquet(path)
        linked = same.select("line").union(same.select("other")).distinct()
        return write_table(alone.join(linked, "line", "left_anti"), "lines-alone")

    usual = own.groupBy("leaf").agg(F.max_by("line", F.struct("weight", "line")).alias("other"))
    alone = still_alone(own.select("leaf", "line").join(alone, "line", "left_semi").join(usual, "leaf").select("line", "other"), alone)
    spare = F.size("places") - F.col("need")
    with_one = own.join(alone, "line", "left_semi").select("leaf").distinct()
    cells = own.join(with_one, "leaf", "left_semi").select(
        "line", "need", "weight", spare.alias("spare"), F.posexplode(F.slice("places", 1, spare + 1)).alias("last", "cell")
    )
    level = 1
    while not alone.isEmpty():
        cells = write_table(cells.join(alone.withColumn("alone", F.lit(True)), "line", "left").fillna(False, ["alone"]), "line-cells")
        further = F.col("spare") + level - F.col("last")
        sizes = cells.groupBy("cell").agg(
            F.count(F.lit(1)).alias("n"), F.count_if("alone").alias("n_alone"), F.sum(further).alias("further"),
            F.max("need").alias("least"), F.max(F.struct("weight", "line", "alone")).alias("usual"),
        ).filter("n >= 2 AND n_alone >= 1")
        few = F.col("n") * F.col("n_alone") <= DIRECT * F.col("further")
        sizes = write_table(sizes.select("cell", "least", "usual", few.alias("few")), "line-cell-sizes")
        if sizes.isEmpty():
            break
        compared = cells.join(sizes.filter("few").select("cell"), "cell").select("cell", "line", "alone")
        pairs = compared.filter("alone").select("cell", "line").join(compared.select("cell", F.col("line").alias("other")), "cell")
        many = sizes.filter("NOT few")
        with_usual = cells.select("cell", "line", "alone").join(many.select("cell", "usual"), "cell")
        to_usual = with_usual.filter("alone").select("line", F.col("usual.line").alias("other"))
        from_usual = with_usual.filter("NOT alone AND usual.alone").select("usual.line", F.col("line").alias("other"))
        alone = still_alone(pairs.select("line", "other").union(to_usual).union(from_usual), alone)
        # Lines of a cell that share all the places needed are all alike.
        parted = many.filter(F.col("least") > level).select("cell")
        parted = parted.join(cells.join(alone, "line", "left_semi").select("cell").distinct(), "cell", "left_semi")
        parted = cells.drop("alone").join(parted, "cell").join(own.select("line", "places"), "line")
        onward = F.posexplode(F.slice("places", F.col("last") + 2, further)).alias("step", "place")
        parted = parted.select("line", "need", "weight", "spare", "last", "cell", onward)
        cells = parted.select(
            "line", "need", "weight", "spare", (F.col("last") + 1 + F.col("step")).alias("last"), F.xxhash64("cell", "place").alias("cell")
        )
        level += 1
    return spark.read.schema(schema).parquet(path)


def recurring_lines(documents: DataFrame, identity: str = "doc_id", text: str = "text", least_texts: int = 2) -> DataFrame:
    """content (hash of the text), dropped (places of its lines that recur)."""
    lines = write_table(_lines(documents, identity, text), "lines")
    # Copies are one text, of the least id; a text is in one row for each of its lines.
    of_line = [F.first(c).alias(c) for c in ("line", *ENDS_AND_BODY, "size")]
    once = lines.groupBy("content", "at").agg(F.min("id").alias("id"), *of_line)
    general = write_table(generalised(_leaf_lines(lines, documents, text)), "general-templates")
    once = once.join(general, "line", "left").withColumn("template", F.coalesce("template", "line")).drop("line")
    once = write_table(once, "templates")
    texts = once.filter("size > 1").groupBy("template", "content").agg(F.min("id").alias("id"), F.max("size").alias("size"))
    least = F.when(F.col("size") < SHORT, F.greatest(F.lit(SHORT_TEXTS), F.lit(least_texts))).otherwise(F.lit(least_texts))
    spread = texts.groupBy("template").agg(
        F.count(F.lit(1)).alias("texts"), F.min(F.struct("id", "content")).alias("first"), F.max("size").alias("size")
    ).filter(F.col("texts") >= least)
    spread = write_table(spread, "recurring-templates")
    firsts = spread.select("template", F.col("first.content").alias("first"))
    inside = write_table(once.select("template", "content", "at").join(firsts, "template"), "recurring-lines")
    recurring = write_table(of_unlike_texts(inside, once), "dropped-templates")
    dropped = inside.join(recurring, "template")
    # The first occurrence of a template in its first text stays.
    first_place = dropped.filter("content = first").groupBy("template").agg(F.min("at").alias("stays"))
    first_place = write_table(first_place, "kept-lines")
    dropped = dropped.join(first_place, "template").filter("content <> first OR at <> stays")
    return dropped.groupBy("content").agg(F.collect_set("at").alias("dropped"))


def drop_recurring_lines(
    documents: DataFrame, identity: str = "doc_id", text: str = "text", lines: str | None = None, dropped: str | None = None
) -> DataFrame:
    """``documents`` with the recurring lines cut out of the text. With names for them,
    the numbers of lines and of dropped lines are further columns."""
    found = write_table(recurring_lines(documents, identity, text), "dropped-lines")
    found = found.select(F.col("content").alias("_content"), F.col("dropped").alias("_dropped"))
    rows = documents.withColumn("_content", _content(F.coalesce(F.col(text), F.lit("")))).join(found, "_content", "left")
    parts = F.split(F.col(text), "\n", -1)
    left = F.array_join(F.filter(parts, lambda line, i: ~F.array_contains("_dropped", i)), "\n")
    out = rows
    if lines:
        out = out.withColumn(lines, F.coalesce(F.size(parts).cast("bigint"), F.lit(0)))
    if dropped:
        out = out.withColumn(dropped, F.coalesce(F.size("_dropped").cast("bigint"), F.lit(0)))
    out = out.withColumn(text, F.when(F.col("_dropped").isNotNull(), left).otherwise(F.col(text)))
    names = [*documents.columns, *[c for c in (lines, dropped) if c]]
    return out.select(*names)
