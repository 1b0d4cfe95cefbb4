import random
import time

import pytest
from pyspark.sql import functions as F

from wakeline.functions.text import lcs_length
from wakeline.operators import enrich
from wakeline.plans import jobs
from wakeline.sources.register import scan_register_text


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def similar(a, b):
    return 10 * lcs(a, b) >= 4 * (len(a) + len(b))


def edited(rng, name, letters):
    name = list(name)
    for _ in range(rng.randint(0, 4)):
        at = rng.randint(0, len(name))
        if rng.random() < 0.5 and name:
            del name[min(at, len(name) - 1)]
        else:
            name.insert(at, rng.choice(letters))
    return "".join(name)


def test_lcs(spark):
    rng = random.Random(1)
    word = lambda n: "".join(rng.choice("abcdé ") for _ in range(rng.randint(0, n)))
    pairs = [(word(15), word(15)) for _ in range(500)] + [(word(70), word(70)) for _ in range(10)]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = df.select("a", "b", lcs_length(F.col("a"), F.col("b")).alias("n")).collect()
    assert [r.n for r in got] == [lcs(r.a, r.b) for r in got]


@pytest.mark.parametrize("letters", ["ab", "abcdefg", "aeinorst lmdé"])
def test_name_matches_equal_all_comparisons(spark, letters):
    rng = random.Random(letters)
    left = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 18))) for _ in range(60)}
    right = {edited(rng, rng.choice(sorted(left)), letters) for _ in range(120)}
    right |= {"".join(rng.choice(letters) for _ in range(rng.randint(1, 18))) for _ in range(40)}
    names = lambda values: spark.createDataFrame(
        [(v,) for v in sorted(values)] + [("",), (None,)], "name string"
    )
    got = {tuple(r) for r in enrich.name_matches(names(left), names(right)).collect()}
    assert got == {(a, b) for a in left for b in right if b and similar(a, b)}


def test_name_matches_ignore_case_and_copies(spark):
    left = spark.createDataFrame([("Red Star",)] * 3 + [("RED STAR",)], "name string")
    right = spark.createDataFrame([("red stars",), ("Red Stars",)], "name string")
    got = enrich.name_matches(left, right).collect()
    assert [tuple(r) for r in got] == [("red star", "red stars")]


PAGE = """<html><a class="ship-link" href="/vessels/OUT-IMO-1-MMSI-2">o</a>
<TABLE><TBODY class=x>
 <a href='/vessels/ONE-IMO-11-MMSI-21' class='big ship-link'>1</a>
 <a class="ship-links" href="/vessels/OTHER-IMO-1-MMSI-2">n</a>
 <a class="ship-link">no target</a>
 <table><tbody><a class="ship-link" href=/vessels/TWO-IMO-12-MMSI-22>2</a></tbody></table>
 <a class="ship-link" href="/vessels/A-IMO-B-IMO-13-MMSI-23">3</a>
</TBODY></TABLE></tbody>
<a class="ship-link" href="/vessels/AFTER-IMO-1-MMSI-2">a</a>
<tbody><a class="ship-link" href="/broken">b</a>
<a class="ship-link" href="/vessels/LAST-IMO-14-MMSI-24">4</a></tbody></html>"""


def test_links_of_nested_containers(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, "no links"), (3, None)], "page_id long, html string")
    links = enrich.page_links(pages)
    order = ["page_id", "part", "pos"]
    assert [r.href for r in links.orderBy(order).collect()] == [
        "/vessels/ONE-IMO-11-MMSI-21",
        "/vessels/TWO-IMO-12-MMSI-22",
        "/vessels/A-IMO-B-IMO-13-MMSI-23",
        "/broken",
        "/vessels/LAST-IMO-14-MMSI-24",
    ]
    vessels = enrich.vessel_links(links).orderBy(order).select("name", "imo", "mmsi")
    assert [tuple(r) for r in vessels.collect()] == [
        ("ONE", "11", "21"),
        ("TWO", "12", "22"),
        ("A-IMO-B", "B-IMO-13", "23"),
        ("LAST", "14", "24"),
    ]


def links_frame(spark, names):
    rows = [(i // 2, 0, i % 2, n, f"i{i}", str(244000000 + i)) for i, n in enumerate(names)]
    return spark.createDataFrame(
        rows, "page_id long, part int, pos int, name string, imo string, mmsi string"
    )


def register_frame(spark, rows):
    return spark.createDataFrame(
        rows,
        "reg_id string, mmsi int, name string, name_scrape string, imo_scrape string, "
        "mmsi_scrape string",
    )


def test_register_match_and_update(spark):
    links = links_frame(spark, ["HARING", "ZEEHOND", "Zeehond", "HARINGS", "UNIEK 12"])
    register = register_frame(
        spark,
        [
            ("a", None, "haring", "old", "old", "old"),
            ("b", None, "uniek 12", None, None, None),
            ("c", 5, "uniek 13", None, None, None),
            ("d", None, "nothing like it", None, None, None),
            ("e", None, "  ", "old", "old", "old"),
            ("f", None, None, "old", "old", "old"),
        ],
    )
    matches = enrich.fuzzy_register_match(register, links)
    order = ["register_name", "page_id", "part", "pos"]
    got = matches.orderBy(order).select("register_name", "name", "imo").collect()
    assert [tuple(r) for r in got] == [
        ("haring", "HARING", "i0"),
        ("haring", "HARINGS", "i3"),
        ("nothing like it", "---", "---"),
        ("uniek 12", "UNIEK 12", "i4"),
        ("uniek 13", "UNIEK 12", "i4"),
    ]
    updated = {r.reg_id: r for r in enrich.register_update(register, matches).collect()}
    assert (updated["a"].mmsi, updated["a"].n_matches, updated["a"].ambiguous) == (None, 2, True)
    assert (updated["a"].name_scrape, updated["a"].imo_scrape) == ("HARING", "i0")
    assert (updated["b"].mmsi, updated["b"].n_matches, updated["b"].ambiguous) == (244000004, 1, False)
    assert updated["b"].name_scrape == "UNIEK 12"
    assert updated["c"].mmsi == 5
    assert updated["d"].name_scrape == updated["d"].mmsi_scrape == "---"
    assert updated["d"].mmsi is None and not updated["d"].ambiguous
    assert updated["e"].imo_scrape == updated["f"].imo_scrape == "old"
    assert updated["e"].n_matches == 0 and not updated["e"].ambiguous


def test_a_name_with_many_matches_is_one_register_row(spark):
    links = links_frame(spark, ["MARIA"] * 5000)
    rows = [("a", None, "maria", None, None, None), ("b", 7, "Maria", None, None, None)]
    register = register_frame(spark, rows)
    matches = enrich.fuzzy_register_match(register, links)
    assert matches.count() == 5000
    updated = enrich.register_update(register, matches).collect()
    assert sorted((r.reg_id, r.mmsi, r.n_matches, r.ambiguous, r.imo_scrape) for r in updated) == [
        ("a", None, 5000, True, "i0"),
        ("b", 7, 5000, False, "i0"),
    ]


def test_completing_a_completed_register(spark, tmp_path):
    """The written result of a run is the register of the next; earlier values survive."""
    register, pages, out = (f"{tmp_path}/{n}" for n in ("register.csv", "pages", "out"))
    with open(register, "wb") as f:
        f.write("id;naam;mmsi\n1;Zeeëend;\n2;Noordster;5\n".encode("latin-1"))
    link = '<tbody><a class="ship-link" href="/vessels/{}-IMO-1-MMSI-{}">x</a></tbody>'
    pages_frame = lambda *names: spark.createDataFrame(
        [(n, link.format(name, 244000000 + n)) for n, name in enumerate(names)],
        "page_id long, html string",
    )
    pages_frame("ZEEËEND", "ANDERS").write.parquet(pages)
    jobs.complete_register(spark, register, pages, "naam", out)
    first = {r.id: r for r in scan_register_text(spark, out).collect()}
    assert (first["1"].naam, first["1"].name_scrape, first["1"].mmsi) == ("Zeeëend", "ZEEËEND", "244000000")
    assert (first["2"].name_scrape, first["2"].mmsi) == ("---", "5")
    # A name that is blanked in between keeps what was found for it.
    blanked = f"{tmp_path}/blanked"
    text = scan_register_text(spark, out)
    text.withColumn("naam", F.when(F.col("id") == "2", F.col("naam"))).coalesce(1).write.csv(
        blanked, header=True, sep=";", encoding="ISO-8859-1"
    )
    pages_frame("NOORDSTER").write.mode("overwrite").parquet(pages)
    jobs.complete_register(spark, blanked, pages, "naam", out + "2")
    second = {r.id: r for r in scan_register_text(spark, out + "2").collect()}
    assert (second["1"].name_scrape, second["1"].mmsi) == ("ZEEËEND", "244000000")
    assert (second["2"].name_scrape, second["2"].mmsi, second["2"].n_matches) == ("NOORDSTER", "5", "1")
    assert second.keys() == first.keys() and text.columns == scan_register_text(spark, out + "2").columns


def test_links_as_a_parser_gives_them(spark):
    page = """<table><!-- <tbody><a href="/no">n</a> --><tbody><a title="a > b" href="/r&amp;d?a=1&#38;b=2">1</a>
    <!-- <a href="/hidden">h</a> --><a href='/q?x=&quot;&lt;&#x41;&#233;&#8364;&gt;&quot;&amp;lt;'>2</a>
    <A HREF=/plain&#0;&#55296;>3</A><a title='it"s' href="/four">4</a><a href="/five" alt=">5</a></tbody>"""
    pages = spark.createDataFrame([(1, page)], "page_id long, html string")
    found = enrich.page_links(pages, css_class=None).orderBy("part", "pos").collect()
    assert [r.href for r in found] == [
        "/r&d?a=1&b=2", '/q?x="<Aé€>"&lt;', "/plain&#0;&#55296;", "/four", "/five"
    ]


def test_names_are_tested_in_several_tasks_and_once(spark):
    """Names with common words meet at several segments and are accepted at one."""
    names = [(f"santa maria {n:05d}",) for n in range(300)] + [(f"star {n}",) for n in range(50)]
    frame = spark.createDataFrame(names, "name string")
    found = enrich.name_matches(frame, frame)
    pairs = [tuple(r) for r in found.collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(a, b) for (a,) in names for (b,) in names if similar(a, b)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [a#" not in plan.split("Join")[0]




@pytest.mark.parametrize("letters", ["ab", "abcdefg"])
def test_frequent_segments_find_the_same_matches(spark, monkeypatch, letters):
    """All segments count as frequent, and classes meet on grids of many cells."""
    monkeypatch.setattr(enrich, "FREQUENT", 2)
    monkeypatch.setattr(enrich, "FREQUENT_SHARE", 0.0)
    monkeypatch.setattr(enrich, "CELL_PAIRS", 2)
    rng = random.Random(letters)
    left = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 16))) for _ in range(70)}
    left |= {f"maria {a}" for a in left if len(a) < 9}
    right = {edited(rng, rng.choice(sorted(left)), letters) for _ in range(120)} | set(list(left)[:20])
    names = lambda values: spark.createDataFrame([(v,) for v in sorted(values)], "name string")
    got = [tuple(r) for r in enrich.name_matches(names(left), names(right)).collect()]
    assert len(got) == len(set(got))
    assert set(got) == {(a, b) for a in left for b in right if b and similar(a, b)}


def test_names_with_shared_words_meet_about_once(spark):
    rng = random.Random(2)
    sides = [[f"santa maria {n:05d}" for n in rng.sample(range(100_000), 400)] for _ in range(2)]
    left, right = (spark.createDataFrame([(n,) for n in side], "name string") for side in sides)
    candidates = enrich.name_candidates(left, right)
    matches = {tuple(r) for r in enrich.name_matches(left, right).collect()}
    assert candidates.count() <= 3 * len(matches)
    pairs = candidates.select("a", "b").distinct().count()
    assert len(matches) <= pairs <= 400 * 400
    for a, b in rng.sample([(a, b) for a in sides[0] for b in sides[1]], 2000):
        assert ((a, b) in matches) == similar(a, b)


def test_the_name_join_runs_once(spark):
    register = spark.createDataFrame([("Ann", 1), ("Zzz", 2)], "name string, mmsi int")
    links = spark.createDataFrame(
        [(1, 0, 0, "ann", "i", "m")],
        "page_id long, part int, pos int, name string, imo string, mmsi string",
    )
    found = enrich.fuzzy_register_match(register, links)
    assert [tuple(r) for r in found.orderBy("register_name").collect()] == [
        ("ann", 1, 0, 0, "ann", "i", "m"), ("zzz", None, None, None, "---", "---", "---"),
    ]
    plan = found._jdf.queryExecution().sparkPlan().toString()
    # No segment is frequent here, so there is one join; names without a match add none.
    assert plan.count("levenshtein(") == 1


def hrefs(spark, page, **options):
    pages = spark.createDataFrame([(1, page)], "page_id long, html string")
    found = enrich.page_links(pages, container="body", css_class=None, **options)
    return [r.href for r in found.orderBy("part", "pos").collect()]


def test_links_of_raw_text_and_values_are_none(spark):
    page = """<TITLE><a href="/title"></TITLE><body><script>if (a<b) x = '<a href="/js">';</script >
    <style><a href="/css"></style><textarea><a href=/area></textarea><div title="<a href='/value'>">
    <!-- <script> --><a href="/one">1</a><script src=x></script><a title=" href=/no" href="/two">
    <a class=href data-href="/no" HREF = '/three'><a href><abbr href=/no><a/ href="/no"><a href="">
    <scripts><a href=/four></scripts><script><a href="/open">"""
    assert hrefs(spark, page) == ["/one", "/two", "/three", "/four"]


def test_references_are_replaced_once_and_from_the_whole_table(spark):
    given = {
        "/&#38;lt;": "/&lt;", "/&amp;lt;": "/&lt;", "/&eacute;&nbsp;&apos;": "/é\xa0'",
        "/a?x=1&copy=2&reg": "/a?x=1&copy=2®", "/&NotEqualTilde;&bogus;&": "/≂̸&bogus;&",
        "/&#233;&#xE9;&#XE9;&#233": "/éééé", "/&#146;&#x80;&#129;": "/’€\x81", "/&&amp;&": "/&&&",
        "/&#99999999999;&#x110000;": "/&#99999999999;&#x110000;", "/plain": "/plain",
        "/&euro;&euro": "/€&euro", "/&amp": "/&", "/&ampx;&ampx": "/&ampx;&ampx",
    }
    page = "<body>" + "".join(f'<a href="{h}">' for h in given)
    assert hrefs(spark, page) == list(given.values())


def test_links_of_large_and_broken_pages_take_linear_time(spark):
    hrefs(spark, "<body><a href=x>")
    start = time.perf_counter()
    many = "<body>" + "".join(f"<b><body><a href='/{n}'></body></b>" for n in range(25_000))
    assert len(hrefs(spark, many)) == 25_000
    deep = "<body>" * 50_000 + "<a href=/deep>" + "</body>" * 50_000 + "<a href=/out>"
    assert hrefs(spark, deep) == ["/deep"]
    for broken in ("<script ", "<a ", "<!--", "<a href=\"", "<a x='", "<body ", "</body", "&#", "<title>"):
        assert hrefs(spark, "<body><a href=/first>" + broken * 50_000)[:1] == ["/first"]
    assert hrefs(spark, "<body><a href='" + "&" * 200_000 + "'>") == ["&" * 200_000]
    assert hrefs(spark, "<body><a " + "x='' " * 50_000 + "href=/last>") == ["/last"]
    assert time.perf_counter() - start < 60


def test_repeated_pages_and_stray_closing_tags(spark):
    page = "</tbody></tbody><tbody><a class='ship-link x' href=/a></tbody></tbody><a class=ship-link href=/b>"
    pages = spark.createDataFrame([(1, page), (1, page), (None, page)], "page_id long, html string")
    found = [(r.page_id, r.href) for r in enrich.page_links(pages).collect()]
    assert sorted(found, key=str) == [(1, "/a"), (1, "/a"), (None, "/a")]


def test_match_lists_hold_every_match_in_order(spark, monkeypatch):
    monkeypatch.setattr(enrich, "LIST_PART", 7)
    monkeypatch.setattr(enrich, "PAGE_BLOCK", 3)
    links = links_frame(spark, ["MARIA"] * 40 + ["Anna", "ANNE", "MARIA"])
    rows = [("a", None, "maria", None, None, None), ("b", 7, "anna", None, None, None),
            ("c", 1, "nothing", "x", "x", "x"), ("d", 1, None, "x", "x", "x")]
    register = register_frame(spark, rows + [("e", None, "Maria", None, None, None)])
    matches = enrich.fuzzy_register_match(register, links)
    lists = enrich.match_lists(matches)
    parts = lists.where("register_name = 'maria'").orderBy("list_part").collect()
    assert [r.n for r in parts] == [7] * 5 + [6]
    wanted = [f"i{n}" for n in [*range(40), 42]]
    assert ",".join(r.imo for r in parts).split(",") == wanted
    updated = enrich.with_match_lists(enrich.register_update(register, matches), lists)
    assert updated.columns == enrich.register_update(register, matches).columns
    found = {r.reg_id: (r.name_scrape, r.imo_scrape, r.n_matches) for r in updated.collect()}
    assert found["a"] == found["e"] == (",".join(["MARIA"] * 7), ",".join(wanted[:7]), 41)
    assert found["b"] == ("Anna", "i40", 1)
    assert found["c"] == ("---", "---", 0) and found["d"] == ("x", "x", 0)


def test_names_that_latin_1_lacks_are_written_as_utf_8(spark, tmp_path):
    register, pages, out = (f"{tmp_path}/{n}" for n in ("register.csv", "pages", "out"))
    with open(register, "wb") as f:
        f.write("id;naam;mmsi\n1;Gdansk Lodz;\n2;Zeeëend;5\n".encode("latin-1"))
    link = '<tbody><a class="ship-link" href="/vessels/Gdańsk Łodz-IMO-1-MMSI-244000001">x</a>'
    spark.createDataFrame([(1, link)], "page_id long, html string").write.parquet(pages)
    assert jobs.complete_register(spark, register, pages, "naam", out) == "UTF-8"
    rows = {r.id: r for r in scan_register_text(spark, out, "UTF-8").collect()}
    assert (rows["1"].name_scrape, rows["1"].mmsi) == ("Gdańsk Łodz", "244000001")
    assert rows["2"].naam == "Zeeëend"
    # Read in its encoding, it can be completed again.
    assert jobs.complete_register(spark, out, pages, "naam", f"{out}2", "UTF-8") == "UTF-8"
    again = {r.id: r for r in scan_register_text(spark, f"{out}2", "UTF-8").collect()}
    assert again["1"].name_scrape == "Gdańsk Łodz" and again["2"].naam == "Zeeëend"


def test_names_that_share_little_meet_rarely(spark):
    """Two or three letters in common are no reason to compare two names."""
    rng = random.Random(5)
    letters = "aeiourstnlmpdcgb"
    word = lambda n: "".join(rng.choice(letters) for _ in range(n))
    left = sorted({f"{word(5)} {word(6)}" for _ in range(1500)})
    near = [a[:3] + a[4:] for a in left[:40]] + [a + " ii" for a in left[40:80]] + [a[1:] + "x" for a in left[80:120]]
    right = sorted({f"{word(5)} {word(6)}" for _ in range(1500)} | set(near))
    frames = [spark.createDataFrame([(n,) for n in side], "name string") for side in (left, right)]
    pairs = enrich.name_candidates(*frames).select("a", "b").collect()
    assert len(pairs) == len(set(pairs)) < 0.005 * len(left) * len(right)
    found = {tuple(r) for r in enrich.name_matches(*frames).collect()}
    assert found >= {(a, b) for a, b in zip(left, near) if similar(a, b)}
    assert len(found) >= 100 and all(similar(a, b) for a, b in found)


@pytest.mark.parametrize("common", ["front", "end"])
def test_names_with_a_common_end_are_cut_at_the_other(spark, monkeypatch, common):
    monkeypatch.setattr(enrich, "FEW_NAMES", 0)
    rng = random.Random(common)
    def side():
        own = {"".join(rng.choice("abcdefgh") for _ in range(rng.randint(5, 7))) for _ in range(150)}
        return sorted(f"santa ana {n}" if common == "front" else f"{n} santa ana" for n in own)
    left, right = side(), side()
    frames = [spark.createDataFrame([(n,) for n in names], "name string") for names in (left, right)]
    got = [tuple(r) for r in enrich.name_matches(*frames).collect()]
    assert len(got) == len(set(got))
    assert set(got) == {(a, b) for a in left for b in right if similar(a, b)}


def rounds_of_names(spark):
    rng = random.Random(11)
    left = {"".join(rng.choice("abcdefg") for _ in range(rng.choice([5, 11]))) for _ in range(90)}
    near = {edited(rng, rng.choice(sorted(left)), "abcdefg") for _ in range(200)}
    right = {n for n in near if len(n) in (5, 6, 11)}
    links = links_frame(spark, [n.upper() for n in sorted(right)] + sorted(right)[:2])
    rows = [(str(n), None, name, None, None, None) for n, name in enumerate([*sorted(left), "zzzzzzz", " ", None])]
    return left, right, register_frame(spark, rows), links


def disk_files(spark):
    return spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()


def test_rounds_of_the_name_join_find_every_match_once(spark, monkeypatch):
    """Keys that are too many for the disk come in rounds, which give their space back."""
    monkeypatch.setattr(enrich, "FEW_NAMES", 0)
    left, right, register, links = rounds_of_names(spark)
    whole = sorted(map(str, enrich.fuzzy_register_match(register, links).collect()))
    monkeypatch.setattr(enrich, "ROUND", 700)
    assert len(enrich._candidate_rounds(register.where("trim(name) != ''"), links)) >= 3
    got = [tuple(r) for r in enrich.name_matches(register.where("trim(name) != ''"), links).collect()]
    assert len(got) == len(set(got))
    assert set(got) == {(a, b) for a in left for b in right if similar(a, b)}
    files = disk_files(spark)
    found = enrich.fuzzy_register_match(register, links)
    for _ in range(50):
        if disk_files(spark) <= files + 20:
            break
        time.sleep(0.2)
    assert disk_files(spark) <= files + 20
    assert found.columns == ["register_name", "page_id", "part", "pos", "name", "imo", "mmsi"]
    assert sorted(map(str, found.collect())) == whole
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"


def test_a_large_meeting_is_divided_by_names():
    meetings = [(12, 12, 8, 2, 2, 1, 6_000_000, 3_000_000), (12, 11, 8, 2, 1, 1, 1000, 1000)]
    rounds = enrich._rounds(meetings, {(12, 12): 10**9})
    assert rounds[0] == ([meetings[1]], (1, 0), (1, 0))
    of = {(a, b) for some, a, b in rounds[1:] if some == meetings[:1]}
    (parts_a,), (parts_b,) = ({x[n][0] for x in of} for n in (0, 1))
    assert of == {((parts_a, i), (parts_b, j)) for i in range(parts_a) for j in range(parts_b)}
    assert len(of) == len(rounds) - 1 > 1
    assert enrich._rounds([], {}) == [([], (1, 0), (1, 0))]


def test_match_lists_are_made_some_names_at_a_time(spark, monkeypatch):
    """Lists of all names at once need the matches on disk several times over."""
    monkeypatch.setattr(enrich, "LIST_PART", 3)
    names = [f"{word} {word}" for word in ("anna", "boreas", "cornelis", "dolfijn", "eems", "friso")]
    links = links_frame(spark, [n.upper() for n in names for _ in range(len(n))])
    rows = [(n, None, n, None, None, None) for n in [*names, "nothing", None]]
    matches = enrich.fuzzy_register_match(register_frame(spark, rows), links)
    whole = sorted(map(tuple, enrich.match_lists(matches).collect()))
    assert sum(r[2] for r in whole) == sum(map(len, names))
    matches = enrich._stored(matches)
    assert enrich._is_read(matches.where("page_id IS NOT NULL"))
    monkeypatch.setattr(enrich, "LIST_ROUND", 20)
    files = disk_files(spark)
    lists = enrich.match_lists(matches)
    for _ in range(50):
        if disk_files(spark) <= files + 20:
            break
        time.sleep(0.2)
    assert disk_files(spark) <= files + 20
    assert sorted(map(tuple, lists.collect())) == whole
    assert len({f.split("/")[-2] for f in lists.inputFiles()}) > 1
