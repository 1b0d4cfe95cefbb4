"""Completion of a register by approximate names from links in web pages."""

import json
import re
import uuid
from functools import reduce
from html.entities import html5
from itertools import product
from math import comb, inf

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from wakeline.functions.text import is_match, lcs_length, letter_bits, letter_places, max_edits
from wakeline.session import shared_folder

# Fixed value: stands for a name without a match.
NO_MATCH = "---"

_SCRAPED = ("name", "imo", "mmsi")

# Columns a completed register has besides its own.
_OWN_COLUMNS = ("n_matches", "ambiguous")

_LINK_ORDER = ["page_id", "part", "pos"]

# Matches in a part of a name's lists, and pages that are counted together.
LIST_PART, PAGE_BLOCK = 1000, 1000

# A key is frequent that so many names hold, and this share of those of a length.
FREQUENT, FREQUENT_SHARE = 100, 0.02
# About as many names of a length as are looked at to tell which keys are frequent.
COUNTED = 20_000
# Pairs of names in a cell of the grid on which two large classes meet.
CELL_PAIRS = 1_000_000
# Keys are weighed against the pairs they lead to as if names were so many letters, all
# equally frequent; a name has at most MOST_KEYS of them for a length.
LETTERS, MOST_KEYS = 10, 5000
# So few names of a length may meet all of another one, so many pairs at the cost of a key.
FEW_NAMES, PAIRS_A_KEY = 100, 20
# Keys that a round of the name join may have on disk together, where a pair takes as much
# as PAIR_KEYS of them; and matches whose lists are made together.
ROUND, PAIR_KEYS, LIST_ROUND = 400_000_000, 2, 20_000_000
# About as many names of a length on either side tell how many pairs rounds have.
SAMPLED = 2000


# The rest of a tag: quoted values may hold any character, a tag with unbalanced quotes
# ends at the first bracket, and one without a bracket lasts to the end of the page.
_TAG_END = r"""(?:[^>"']*+(?:(?:"[^"]*+"|'[^']*+')[^>"']*+)*+>|[^>]*+>?)"""

# Elements whose content is text whatever it looks like.
_RAW_TEXT = "script|style|textarea|title|xmp|iframe|noembed|noframes"


def _tokens(html: Column, container: str) -> Column:
    """Links and the container's tags in their order, from one pass over the page.

    Comments, raw text and other tags are passed over as a whole and leave empty texts.
    What is not closed lasts to the end, so no part is read again and again.
    """
    wanted = rf"<a\s{_TAG_END}|</?{container}(?=[\s/>]){_TAG_END}"
    raw = rf"<({_RAW_TEXT})(?=[\s/>]){_TAG_END}(?:.*?</\2(?=[\s/>])|.*)"
    pattern = rf"(?is)({wanted})|<!--(?:.*?-->|.*)|{raw}|</?[a-z]{_TAG_END}"
    return F.regexp_extract_all(html, F.lit(pattern), F.lit(1))


def _attribute(tag: Column, name: str) -> Column:
    """Value of a link's first attribute of a name, quoted or not; empty where there is none."""
    value = r"""(?:"[^"]*+"|'[^']*+'|[^\s>"']++)"""
    others = rf"""(?:[\s/]++(?!{name}[\s=])[^\s=>/"']++(?:\s*+=\s*+{value})?+)*+"""
    found = F.regexp_extract(tag, rf"(?is)^<a{others}[\s/]++{name}\s*+=\s*+({value})", 1)
    quoted = found.startswith('"') | found.startswith("'")
    return F.when(quoted, F.substr(found, F.lit(2), F.length(found) - 2)).otherwise(found)


def _named_references() -> Column:
    """What each named reference stands for, with and without the sign at its end.

    By first letter, as Spark looks a key up by going through them.
    """
    table: dict[str, dict[str, str]] = {}
    for name, characters in html5.items():
        table.setdefault(name[0], {})[f"&{name}"] = characters
    return F.from_json(F.lit(json.dumps(table)), "map<string,map<string,string>>")


def _windows_characters() -> str:
    """What numbers 128 to 159 stand for, as pages use them: code page 1252."""
    return "".join(
        bytes([code]).decode("cp1252", "ignore") or chr(code) for code in range(128, 160)
    )


def _decoded(text: Column) -> Column:
    """The text with its character references replaced, each once, as in an attribute.

    A name without the sign at its end is left alone before an equals sign. Numbers that
    stand for no character stay as they are.
    """
    pieces = F.regexp_extract_all(
        text,
        F.lit(r"&#[0-9]++;?|&#[xX][0-9a-fA-F]++;?|&[A-Za-z][A-Za-z0-9]*+;?(?:(?<!;)=)?|[^&]++|&"),
        F.lit(0),
    )

    def replaced(piece: Column) -> Column:
        digits = F.regexp_extract(piece, "^&#[xX]?([0-9a-fA-F]+)", 1)
        base = F.when(F.lower(F.substring(piece, 3, 1)) == "x", 16).otherwise(10)
        code = F.when(F.length(digits) <= 9, F.when(base == 16, F.conv(digits, 16, 10)).otherwise(digits))
        code = code.try_cast("int")
        is_character = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        character = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        windows = F.substr(F.lit(_windows_characters()), code - 127, F.lit(1))
        number = F.when(code.between(128, 159), windows).when(is_character, character)
        named = F.element_at(F.element_at(_named_references(), F.substring(piece, 2, 1)), piece)
        return (
            F.when(~piece.startswith("&"), piece)
            .when(piece == "&amp;", "&")
            .when(piece.startswith("&#"), F.coalesce(number, piece))
            .otherwise(F.coalesce(named, piece))
        )

    return F.when(text.contains("&"), F.array_join(F.transform(pieces, replaced), "")).otherwise(text)


def page_links(
    pages: DataFrame, container: str = "tbody", css_class: str | None = "ship-link"
) -> DataFrame:
    """Targets of the links of a class inside a container, with their place on the page.

    ``part`` and ``pos`` order the links of a page. Links in comments, scripts and values
    are none, and character references are replaced as a parser does. Depth inside the
    containers is a running sum over the tags of a page, which takes time in proportion
    to them; closing tags too many count for nothing.
    """
    token = F.col("token")
    start = F.lower(F.substring("token", 1, 2 + len(container)))
    change = (
        F.when(start.startswith(f"<{container}"), 1).when(start == f"</{container}", -1).otherwise(0)
    )
    classes = F.split(_attribute(token, "class"), r"\s+")
    of_class = F.lit(True) if css_class is None else F.array_contains(classes, css_class)
    in_order = Window.partitionBy("page").orderBy("pos")
    floor = F.least(F.min("total").over(in_order), F.lit(0))
    return (
        pages.withColumn("page", F.monotonically_increasing_id())
        .select("page_id", "page", F.posexplode(_tokens(F.col("html"), container)).alias("pos", "token"))
        .where(token.endswith(">"))
        .withColumn("change", change)
        .where((F.col("change") != 0) | of_class)
        .withColumn("total", F.sum("change").over(in_order))
        .withColumn("part", F.sum(F.abs("change")).over(in_order).cast("int"))
        .withColumn("floor", floor)
        .where("change = 0 AND total > floor")
        .select("page_id", "part", "pos", _decoded(_attribute(token, "href")).alias("href"))
        .where("href != ''")
    )


def vessel_links(links: DataFrame) -> DataFrame:
    """Name, IMO number and MMSI from links to vessel pages; other links are left out."""
    # The shape of a vessel link.
    name, imo, mmsi = r"/vessels/(.*)-IMO", r"-IMO-(.*)-MMSI", r"-MMSI-(.*)"
    href = F.col("href")
    return links.where(href.rlike(name) & href.rlike(imo) & href.rlike(mmsi)).select(
        *_LINK_ORDER,
        F.regexp_extract(href, name, 1).alias("name"),
        F.regexp_extract(href, imo, 1).alias("imo"),
        F.regexp_extract(href, mmsi, 1).alias("mmsi"),
    )


def _distinct_names(names: DataFrame, alias: str) -> DataFrame:
    return (
        names.select(F.lower("name").alias(alias))
        .where(F.col(alias) != "")
        .distinct()
        .withColumn(f"id_{alias}", F.xxhash64(alias))
        .withColumn(f"len_{alias}", F.length(alias))
        .withColumn(f"bits_{alias}", letter_bits(F.col(alias)))
    )


def _ends(names: DataFrame, own: str) -> dict[int, Row]:
    """For each length how many names have it, and about how many first and last halves.

    One row a length goes to the driver.
    """
    name, length = F.col(own), F.col(f"len_{own}")
    half = F.ceil(length / 2).cast("int")
    counts = names.groupBy(length.alias("length")).agg(
        F.count("*").alias("n"),
        F.approx_count_distinct(F.left(name, half)).alias("first"),
        F.approx_count_distinct(F.right(name, half)).alias("last"),
    )
    return {r.length: r for r in counts.collect()}


def _work(n_a: int, n_b: int, size: int, spare_a: int, spare_b: int) -> tuple[float, float, float]:
    """Keys of the left and right names of two lengths, and the pairs they lead to."""
    if not size:
        return n_a, n_b, n_a * n_b / PAIRS_A_KEY
    keys_a, keys_b = comb(size + spare_a, spare_a), comb(size + spare_b, spare_b)
    pairs = n_a * n_b * min(1.0, keys_a * keys_b / LETTERS**size)
    return n_a * keys_a, n_b * keys_b, pairs


def _kept_letters(n_a: int, n_b: int, least: int, spare_a: int, spare_b: int) -> int:
    """How many letters a key has: the number for which keys and pairs are fewest.

    None where few names meet many: all pairs meet on a grid, which looks at their letters.
    """
    best, fewest = 0, inf
    if min(n_a, n_b) <= FEW_NAMES:
        fewest = sum(_work(n_a, n_b, 0, spare_a, spare_b))
    for size in range(1, least + 1):
        keys_a, keys_b, pairs = _work(n_a, n_b, size, spare_a, spare_b)
        most = comb(size + max(spare_a, spare_b), size)
        if keys_a + keys_b >= fewest or (best and most > MOST_KEYS):
            break
        if keys_a + keys_b + pairs < fewest:
            best, fewest = size, keys_a + keys_b + pairs
    return best


def _meetings(names_a: DataFrame, names_b: DataFrame) -> list[tuple[int, ...]]:
    """For each two lengths that can match: both, letters of a key, letters that may be
    spare left and right, whether keys are cut from the front, and the names of both."""
    ends_a, ends_b = _ends(names_a, "a"), _ends(names_b, "b")
    found = []
    for len_a, a in sorted(ends_a.items()):
        for len_b, b in sorted(ends_b.items()):
            least = -(-4 * (len_a + len_b) // 10)
            if least > min(len_a, len_b):
                continue
            spare_a, spare_b = len_a - least, len_b - least
            size = _kept_letters(a.n, b.n, least, spare_a, spare_b)
            front = a["first"] * b["first"] > a["last"] * b["last"]
            found.append((len_a, len_b, size, spare_a, spare_b, int(front), a.n, b.n))
    return found


def _rounds(
    meetings: list[tuple[int, ...]], met: dict[tuple[int, int], int]
) -> list[tuple[list[tuple[int, ...]], tuple[int, int], tuple[int, int]]]:
    """The meetings in rounds of bounded work, with the part of the left and right names.

    ``met`` are pairs by two lengths where they were counted. Small meetings are put together. One that is too large is divided: each part of the left
    names meets each of the right ones, in a round of its own.
    """
    together, free, divided = [[]], ROUND, []
    for meeting in meetings:
        _, _, size, spare_a, spare_b, _, n_a, n_b = meeting
        keys_a, keys_b, pairs = _work(n_a, n_b, size, spare_a, spare_b)
        pairs = PAIR_KEYS * max(pairs, met.get(meeting[:2], 0))
        parts_a = parts_b = 1
        while (work := keys_a / parts_a + keys_b / parts_b + pairs / (parts_a * parts_b)) > ROUND:
            if keys_a / parts_a > keys_b / parts_b:
                parts_a += 1
            else:
                parts_b += 1
        if parts_a * parts_b > 1:
            of = product(range(parts_a), range(parts_b))
            divided += [([meeting], (parts_a, a), (parts_b, b)) for a, b in of]
            continue
        if work > free and together[-1]:
            together.append([])
            free = ROUND
        together[-1].append(meeting)
        free -= work
    whole = [(some, (1, 0), (1, 0)) for some in together if some]
    return [*whole, *divided] or [([], (1, 0), (1, 0))]


def _subsequences(window: Column, size: Column, spare: Column) -> Column:
    """The distinct texts of ``size`` letters that are left when ``spare`` ones go."""
    letters = F.transform(
        F.split(window, ""), lambda letter, at: F.struct(letter.alias("letter"), at.alias("at"))
    )

    def step(texts: Column, next_letter: Column) -> Column:
        open_ = F.filter(texts, lambda t: F.length(t) < size)
        longer = F.transform(open_, lambda t: F.concat(t, next_letter["letter"]))
        without = F.filter(texts, lambda t: next_letter["at"] - F.length(t) < spare)
        return F.array_union(longer, without)

    nothing = F.array(F.lit(""))
    left = F.when(size == 0, nothing).when(spare == 0, F.array(window))
    return left.otherwise(F.aggregate(letters, nothing, step))


def _at_lengths(names: DataFrame, own: str, meetings: list[tuple[int, ...]]) -> DataFrame:
    """Each name with every length of the other side it can match, and how it is cut for it."""
    by_length: dict[int, list[dict[str, int]]] = {}
    for len_a, len_b, size, spare_a, spare_b, front, n_a, n_b in meetings:
        length, spare, n = (len_a, spare_a, n_a) if own == "a" else (len_b, spare_b, n_b)
        cut = {"len_a": len_a, "len_b": len_b, "size": size, "spare": spare, "front": front, "n": n}
        by_length.setdefault(length, []).append(cut)
    shape = "map<string,array<struct<len_a:int,len_b:int,size:int,spare:int,front:int,n:bigint>>>"
    cuts = F.from_json(F.lit(json.dumps(by_length)), shape)
    return names.select(
        f"id_{own}", own, f"bits_{own}",
        F.inline(F.element_at(cuts, F.col(f"len_{own}").cast("string"))),
    )


def _keys(rows: DataFrame, own: str) -> DataFrame:
    """A row for each key of a name: what is left of its end when the spare letters go."""
    name, size, spare = F.col(own), F.col("size"), F.col("spare")
    taken = size + spare
    window = F.when(F.col("front") == 1, F.left(name, taken)).otherwise(F.right(name, taken))
    return (
        rows.withColumn("window", window)
        .withColumn("text", F.explode(_subsequences(F.col("window"), size, spare)))
        .withColumn("key", F.xxhash64("len_a", "len_b", "text"))
    )


def _frequent_keys(rows: DataFrame) -> DataFrame:
    """Keys that many left names of a length share; of many names COUNTED tell which.

    At most 1 / FREQUENT_SHARE of them for each way to cut a name. They only decide
    how names meet, not which.
    """
    frequent = (F.col("held_a") >= FREQUENT) & (F.col("held_a") >= FREQUENT_SHARE * F.col("n_a"))
    counts = _held(rows.where(F.col("n") >= FREQUENT), "a", COUNTED)
    return counts.where(frequent).select("key", "len_a", "len_b")


def _held(rows: DataFrame, own: str, counted: int) -> DataFrame:
    """About how many names hold each key, from some ``counted`` names of a length."""
    step = F.greatest(F.lit(1), F.floor(F.col("n") / counted))
    some = _keys(rows.where(F.pmod(f"id_{own}", step) == 0), own)
    held = F.count("*") * F.max(step)
    return some.groupBy("key", "len_a", "len_b").agg(held.alias(f"held_{own}"), F.max("n").alias(f"n_{own}"))


def _pairs_met(
    names_a: DataFrame, names_b: DataFrame, meetings: list[tuple[int, ...]]
) -> dict[tuple[int, int], int]:
    """About how many pairs of names of two lengths share a key, as often as they do.

    Only counted where rounds may be needed. One row for two lengths goes to the driver.
    """
    cut = [m for m in meetings if m[2]]
    if sum(sum(_work(m[6], m[7], *m[2:5])) for m in meetings) < ROUND / 8:
        return {}
    a, b = (_held(_at_lengths(x, own, cut), own, SAMPLED) for x, own in ((names_a, "a"), (names_b, "b")))
    both = a.hint("merge").join(b, ["key", "len_a", "len_b"])
    pairs = F.sum(F.col("held_a") * F.col("held_b"))
    rows = _stored(both.groupBy("len_a", "len_b").agg(pairs.alias("pairs"))).collect()
    return {(r.len_a, r.len_b): r.pairs for r in rows}


def _written(rows: DataFrame, path: str) -> None:
    """Write a table whose shuffles give back their disk space when it is there."""
    spark, setting = rows.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        rows.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)


def _stored(*rounds: DataFrame) -> DataFrame:
    """The rows as a table, as several parts of the plan use them.

    Of several frames one is made after the other, so the disk holds the shuffles of one.
    """
    spark = rounds[0].sparkSession
    path = f"{shared_folder(spark)}/wakeline-names-{uuid.uuid4().hex}"
    paths = [f"{path}/{n}" for n in range(len(rounds))]
    for rows, to in zip(rounds, paths, strict=True):
        _written(rows, to)
    return spark.read.schema(rounds[0].schema).parquet(*paths)


def _one_by_one(rounds: list[DataFrame]) -> DataFrame:
    """The rows of all rounds: a single one is left to the plan it becomes a part of."""
    return _stored(*rounds) if len(rounds) > 1 else rounds[0]


def _by_held(keys: DataFrame, frequent: DataFrame, own: str) -> DataFrame:
    """Each name with all frequent keys it holds, in order."""
    return (
        keys.join(frequent.hint("merge").select("key"), "key", "left_semi")
        .groupBy(f"id_{own}", f"bits_{own}", "len_a", "len_b")
        .agg(F.sort_array(F.collect_set("key")).alias(f"held_{own}"))
    )


def _few_letters() -> Column:
    """Whether letters that only one name has leave the pair similar enough."""
    only_a = F.bit_count(F.col("bits_a").bitwiseAND(F.bitwise_not("bits_b")))
    only_b = F.bit_count(F.col("bits_b").bitwiseAND(F.bitwise_not("bits_a")))
    edits = max_edits(F.col("len_a"), F.col("len_b"))
    longer = F.col("len_b") - F.col("len_a")
    return (2 * only_a <= edits - longer) & (2 * only_b <= edits + longer)


def _met_on_grid(a: DataFrame, b: DataFrame, tasks: int) -> DataFrame:
    """Pairs that share keys they are known to hold, each once.

    Names that hold the same such keys are one class. Classes meet on their keys, and
    only then the names of two classes that share one: on a grid, whose cells are tasks
    of bounded size however many names a class has.
    """
    lengths = ["len_a", "len_b"]

    def classes(names: DataFrame, held: str) -> DataFrame:
        sizes = names.groupBy(*lengths, held).agg(F.count("*").alias(f"n_{held}"))
        return sizes.select("*", F.explode(held).alias("key"))

    common = F.array_min(F.array_intersect("held_a", "held_b"))
    side = F.ceil(F.sqrt(F.col("n_held_a") * F.col("n_held_b") / CELL_PAIRS))
    met = (
        classes(a, "held_a")
        .hint("merge")
        .join(classes(b, "held_b"), ["key", *lengths])
        .where(common == F.col("key"))
        .select(*lengths, "held_a", "held_b", side.cast("int").alias("side"))
    )
    every, last = F.explode(F.sequence(F.lit(0), F.col("side") - 1)), F.col("side")
    left = (
        a.join(met.hint("merge"), [*lengths, "held_a"])
        .withColumn("cell_a", F.pmod("id_a", last).cast("int"))
        .withColumn("cell_b", every)
        .drop("side")
    )
    right = (
        b.join(met.hint("merge"), [*lengths, "held_b"])
        .withColumn("cell_b", F.pmod("id_b", last).cast("int"))
        .withColumn("cell_a", every)
        .drop("side")
    )
    # Cells are few bytes and much work, so their number of tasks is given: a shuffle
    # that goes by bytes would put them together.
    cell = [*lengths, "held_a", "held_b", "cell_a", "cell_b"]
    left, right = (
        x.select(f"id_{own}", f"bits_{own}", *cell).repartition(tasks, *cell)
        for x, own in ((left, "a"), (right, "b"))
    )
    return left.hint("merge").join(right, cell).where(_few_letters()).select("id_a", "id_b")


def _candidate_rounds(left: DataFrame, right: DataFrame) -> list[DataFrame]:
    """Pairs of distinct lower-case names that share a key, each once.

    Of two similar names at least ``least`` letters are common, in their order, so from
    either end both hold the same ``size`` letters within ``size`` and the spare ones.
    A pair is in one round only, as rounds differ in lengths or in names.
    """
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    of_right = _distinct_names(right, "b").withColumn("places_b", letter_places(F.col("b")))
    names_a, names_b = (_stored(x) for x in (_distinct_names(left, "a"), of_right))
    meetings = _meetings(names_a, names_b)
    frequent = _stored(_frequent_keys(_at_lengths(names_a, "a", [m for m in meetings if m[2]])))
    # Few lengths have such keys; names are cut once for all others.
    crowded = {tuple(r) for r in frequent.select("len_a", "len_b").distinct().collect()}
    rounds = _rounds(meetings, _pairs_met(names_a, names_b, meetings))

    def taken(names: DataFrame, own: str, lengths: list[int], part: tuple[int, int]) -> DataFrame:
        if len(rounds) > 1:
            names = names.where(F.col(f"len_{own}").isin(lengths))
        if part[0] > 1:
            # Not the bits that cells of a grid go by.
            names = names.where(F.pmod(F.shiftright(f"id_{own}", 32), F.lit(part[0])) == part[1])
        return names.repartition(tasks, f"id_{own}")

    return [
        _candidates(
            taken(names_a, "a", sorted({m[0] for m in some}), part_a),
            taken(names_b, "b", sorted({m[1] for m in some}), part_b),
            some, frequent, crowded, tasks,
        )
        for some, part_a, part_b in rounds
    ]


def _candidates(
    names_a: DataFrame,
    names_b: DataFrame,
    meetings: list[tuple[int, ...]],
    frequent: DataFrame,
    crowded: set[tuple[int, int]],
    tasks: int,
) -> DataFrame:
    """The pairs of one round."""

    def keys(some: list[tuple[int, ...]]) -> tuple[DataFrame, DataFrame]:
        rows = ((names_a, "a"), (names_b, "b"))
        return tuple(_keys(_at_lengths(names, own, some), own) for names, own in rows)

    def joined(a: DataFrame, b: DataFrame) -> DataFrame:
        # Neither side has a size bound and the keys multiply both, which size estimates
        # miss: merge, never broadcast.
        return a.select("key", "id_a").hint("merge").join(b.select("key", "id_b"), "key").drop("key")

    cut, whole = ([m for m in meetings if bool(m[2]) == keyed] for keyed in (True, False))
    by_keys = [m for m in cut if m[:2] not in crowded]
    both = [m for m in cut if m[:2] in crowded]
    parts = []
    if by_keys or not meetings:
        parts.append(joined(*keys(by_keys)))
    if both:
        a, b = keys(both)
        parts.append(joined(a.join(frequent.hint("merge").select("key"), "key", "left_anti"), b))
        a, b = (_by_held(x, frequent, own) for x, own in ((a, "a"), (b, "b")))
        parts.append(_met_on_grid(a, b, tasks))
    if whole:
        rows = [_at_lengths(names, own, whole) for names, own in ((names_a, "a"), (names_b, "b"))]
        a, b = (x.withColumn(f"held_{own}", F.array(F.lit(0))) for x, own in zip(rows, "ab", strict=True))
        parts.append(_met_on_grid(a, b, tasks))
    met = reduce(DataFrame.unionAll, parts)
    # The names come back by number, in tasks whose count is given: pairs are few bytes
    # and much work. Names that share a number only add pairs.
    return (
        met.distinct()
        .repartition(tasks, "id_a")
        .join(names_a.hint("merge"), "id_a")
        .repartition(tasks, "id_b")
        .join(names_b.hint("merge"), "id_b")
        .select("a", "bits_a", "b", "bits_b", "places_b", "len_a", "len_b")
    )


def name_candidates(left: DataFrame, right: DataFrame) -> DataFrame:
    """The pairs of all rounds, each once."""
    return reduce(DataFrame.unionAll, _candidate_rounds(left, right))


def _similar(candidates: DataFrame) -> DataFrame:
    """The candidates that match: cheap tests first, the exact ratio decides."""
    few_edits = F.call_function("levenshtein", "a", "b", max_edits(F.col("len_a"), F.col("len_b"))) >= 0
    total_length = F.col("len_a") + F.col("len_b")
    similar = is_match(lcs_length(F.col("a"), F.col("b"), F.col("places_b")), total_length)
    # The cheap tests stay compiled with the join. What is left unfolds to one row with
    # the verdict, as a second filter would be merged into the first and slow it down.
    cheap = F.when(_few_letters(), few_edits).otherwise(F.lit(False))
    return (
        candidates.where(cheap)
        .select("a", "b", F.explode_outer(F.array(similar)).alias("similar"))
        .where("similar")
        .select("a", "b")
    )


def name_matches(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs of similar lower-case names from two frames with a column ``name``.

    Each distinct name takes part once, however many rows carry it, and the frames are
    read once. Two matching names have a common subsequence of a least length. So an
    equi-join on (both lengths, the first or last letters of it) finds every match.
    Pairs are numbers until each is there once; then the names come to them. Letter
    counts and then edit distance reject candidates, the ratio decides. Where the keys are
    too many to be on disk together, rounds over lengths and names are stored one by one.
    """
    return _one_by_one([_similar(pairs) for pairs in _candidate_rounds(left, right)])


def _has_name() -> Column:
    return F.trim(F.coalesce(F.col("name"), F.lit(""))) != ""


def fuzzy_register_match(register: DataFrame, links: DataFrame) -> DataFrame:
    """The matches of every distinct lower-case register name, one row each.

    page_id, part and pos order the matches of a name. A name without a match has one
    row with ``---`` and no place. ``links`` is read for its names and for its rows;
    where making it is dear, pass a written table.
    """
    names = register.where(_has_name()).select("name")
    every = names.select(F.lower("name").alias("register_name")).distinct()
    rounds = [_similar(pairs) for pairs in _candidate_rounds(names, links)]
    of_name = F.lower(links["name"]) == F.col("b")
    columns = ["register_name", *_LINK_ORDER, *_SCRAPED]
    if len(rounds) == 1:
        # The names without a match come out of the same joins, which run once.
        scraped = (F.when(F.col("b").isNull(), NO_MATCH).otherwise(F.col(c)).alias(c) for c in _SCRAPED)
        return (
            every.join(rounds[0], F.col("register_name") == F.col("a"), "left")
            .join(links, of_name, "left")
            .select("register_name", *_LINK_ORDER, *scraped)
        )
    # Rounds take their links along, so the matches move no more; names without a match
    # are those that no round has.
    found = _stored(
        *(pairs.withColumnRenamed("a", "register_name").join(links, of_name).select(*columns) for pairs in rounds)
    )
    nothing = (F.lit(None).cast(links.schema[c].dataType).alias(c) for c in _LINK_ORDER)
    without = every.join(found.select("register_name").distinct(), "register_name", "left_anti").select(
        "register_name", *nothing, *(F.lit(NO_MATCH).alias(c) for c in _SCRAPED)
    )
    return found.unionAll(without)


def _is_read(rows: DataFrame) -> bool:
    """Whether the rows only have to be read, so that doing it again costs little."""
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    return not re.search(r"\b(Join|Aggregate|Window|Generate|RepartitionByExpression|Sort)\b", plan)


def match_lists(matches: DataFrame) -> DataFrame:
    """The matches of each name as comma lists, in parts of LIST_PART of them.

    register_name, list_part, n, and name, imo and mmsi in the order of the pages. Some
    LIST_ROUND matches are put into lists at a time, those of a name together.
    """
    found = matches.where("page_id IS NOT NULL")
    if not _is_read(found):
        found = _stored(found)
    rounds = -(-found.count() // LIST_ROUND)
    if rounds <= 1:
        return _lists(found)
    own = F.pmod(F.xxhash64("register_name"), F.lit(rounds))
    return _stored(*(_lists(found.where(own == n)) for n in range(rounds)))


def _lists(found: DataFrame) -> DataFrame:
    """The lists of some names, with all their matches.

    A part ends after LIST_PART matches, so no group and no value grows with a name's
    matches: they are counted by blocks of pages first, and numbered inside a block after that.
    """
    found = found.withColumn("block", F.floor(F.col("page_id") / PAGE_BLOCK))
    blocks = found.groupBy("register_name", "block").agg(F.count("*").alias("in_block"))
    through = F.sum("in_block").over(Window.partitionBy("register_name").orderBy("block"))
    before = blocks.select("register_name", "block", (through - F.col("in_block")).alias("before"))
    in_order = [*_LINK_ORDER, *_SCRAPED]
    number = F.row_number().over(Window.partitionBy("register_name", "block").orderBy(*in_order))
    numbered = found.withColumn("number", number).join(before, ["register_name", "block"])
    part = F.floor((F.col("before") + F.col("number") - 1) / LIST_PART).cast("int")
    held = F.sort_array(F.collect_list(F.struct(*in_order)))
    return (
        numbered.groupBy("register_name", part.alias("list_part"))
        .agg(F.count("*").alias("n"), held.alias("held"))
        .select("register_name", "list_part", "n", *(_list(f"held.{c}", ",", c) for c in _SCRAPED))
    )


def _list(column: str, between: str, alias: str) -> Column:
    # A missing value keeps its place between the commas.
    every = F.transform(F.col(column), lambda value: F.coalesce(value, F.lit("")))
    return F.array_join(every, between).alias(alias)


def with_match_lists(updated: DataFrame, lists: DataFrame) -> DataFrame:
    """An updated register whose three columns hold all matches of a name as comma lists.

    Names with more than LIST_PART matches have the first of them there, and the rest in
    the other parts of ``lists``; n_matches counts them all. No row multiplies.
    """
    first = lists.where("list_part = 0").select(
        "register_name", *(F.col(c).alias(f"_{c}") for c in _SCRAPED)
    )
    key = F.when(_has_name(), F.lower("name"))
    return updated.join(first, key == F.col("register_name"), "left").select(
        *(
            F.coalesce(f"_{c.removesuffix('_scrape')}", c).alias(c)
            if c in [f"{s}_scrape" for s in _SCRAPED]
            else F.col(c)
            for c in updated.columns
        )
    )


def register_update(register: DataFrame, matches: DataFrame) -> DataFrame:
    """One row per register row, completed from the matches of its name.

    name_scrape, imo_scrape and mmsi_scrape hold the first match on the pages, or
    ``---``; n_matches counts them. A missing or unreadable mmsi is filled from a
    single match; several are only flagged as ambiguous. Rows without a name keep the
    values of an earlier run, whose result can be passed in again.
    """
    register = register.drop(*_OWN_COLUMNS)
    with_earlier = register.withColumns(
        {
            c: F.lit(None).cast("string")
            for c in ("mmsi", *(f"{c}_scrape" for c in _SCRAPED))
            if c not in register.columns
        }
    )
    per_name = matches.groupBy("register_name").agg(
        F.min(F.struct(*_LINK_ORDER, *_SCRAPED)).alias("first"),
        F.count("page_id").alias("n_matches"),
    )
    # Rows without a name would all meet at one key; they join nothing.
    key = F.when(_has_name(), F.lower("name"))
    named = with_earlier.where(_has_name())
    joined = named.join(per_name, key == per_name["register_name"], "left")
    nameless = with_earlier.where(~_has_name()).select(
        "*", F.lit(None).cast(per_name.schema["first"].dataType).alias("first"),
        F.lit(0).cast("bigint").alias("n_matches"),
    )
    rows = joined.drop("register_name").unionByName(nameless)
    scraped = {
        f"{c}_scrape": F.when(_has_name(), F.coalesce(f"first.{c}", F.lit(NO_MATCH))).otherwise(
            F.col(f"{c}_scrape")
        )
        for c in _SCRAPED
    }
    own = F.col("mmsi").try_cast("int")
    single = F.when(F.col("n_matches") == 1, F.col("first.mmsi").try_cast("int"))
    values = scraped | {"mmsi": F.coalesce(own, single)}
    return rows.select(
        *(values.get(c, F.col(c)).alias(c) for c in with_earlier.columns),
        F.coalesce("n_matches", F.lit(0)).alias("n_matches"),
        (own.isNull() & (F.coalesce("n_matches", F.lit(0)) > 1)).alias("ambiguous"),
    )
