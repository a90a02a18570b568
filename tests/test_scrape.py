"""Record extraction from (synthetic) stored pages: profile fields, scouting pairs, overlay, schema."""

from pyspark.sql import functions as F

from valuelens.plans.scrape import records_from_pages
from valuelens.sources import html as hx
from valuelens.sources.mappings import stat_mapping_rows

PLAYER = """<html><div id="info"><h1>Jan  Novák</h1>
<p><a href="/en/country/CZE/Czechia">Czechia</a> <span id="necro-birth" data-birth="2000-02-29">Feb 29</span>
<span>183cm</span> Position:&nbsp;FW-MF Footed: Right</p></div>
<!-- <table id="scout_full_FW"><tbody>
<tr><th data-stat="statistic">Goals</th><td data-stat="per90">0.45</td></tr>
<tr><th data-stat="statistic">npxG + xAG</th><td data-stat="per90">-0.00</td></tr>
<tr><th data-stat="statistic">Shots Total</th><td data-stat="per90">+2.10</td></tr>
<tr><th data-stat="statistic">Goals</th><td data-stat="per90">0.50</td></tr>
<tr><th data-stat="statistic">Unknown Label</th><td data-stat="per90">9</td></tr>
</tbody></table> --></html>"""

KEEPER = """<html><h1>Keeper One</h1> Position: GK Footed: Left
<table id="scout_full_GK"><tr><th data-stat="statistic">Saves</th><td data-stat="per90">3.2</td></tr>
<tr><th data-stat="statistic">Goals</th><td data-stat="per90">0.1</td></tr></table></html>"""

CLUB = """<html><table id="stats_standard_9"><tbody><tr class="thead"><th>x</th></tr>
<tr><th data-stat="player"><a href="/players/jan">Jan Novák</a></th><td data-stat="games">10</td>
<td data-stat="minutes">900</td><td data-stat="goals">4</td><td data-stat="assists">0</td><td data-stat="xg">3.1</td>
<td data-stat="xg_assist">1,5</td></tr></tbody></table></html>"""


def test_mapping_has_56_rows():
    assert len(stat_mapping_rows()) == 56


def test_club_rows(spark):
    club = spark.createDataFrame([(9, "https://site.example/club/9", CLUB)], "page_id long, url string, html string")
    r = hx.club_player_rows(club).first()
    assert (r.player_name, r.player_url, r.appearances, r.minutes_played, r.goals, r.assists, r.xG, r.xAG) == (
        "Jan Novák", "https://site.example/players/jan", 10, 900, 4, 0, 3.1, 15.0)


def test_records(spark):
    pages = spark.createDataFrame(
        [(1, "https://site.example/players/jan", PLAYER), (2, "https://site.example/players/k1", KEEPER)],
        "page_id long, url string, html string")
    club = spark.createDataFrame([(9, "https://site.example/club/9", CLUB)], "page_id long, url string, html string")
    rows = hx.club_player_rows(club).withColumn("league", F.lit("Test League")).withColumn("current_club", F.lit("Club 9"))
    rec = records_from_pages(pages, "2023-03-01", rows)
    assert len(rec.columns) == 70
    by = {r.player_name: r for r in rec.collect()}
    jan = by["Jan  Novák"]
    assert jan.nationality == "Czechia" and jan.height == 183.0 and jan.position == "FW-MF" and jan.foot == "Right"
    assert jan.age == 23.0
    assert jan.npxg_xag_per90 is None              # '-0.00' -> NULL
    assert jan.shots_per90 == 2.1
    assert jan.goals_per_90 == round(4 / 10, 2)    # recomputed from club totals (900 min)
    assert (jan.appearances, jan.minutes_played, jan.goals, jan.assists) == (10, 900, 4, 0)
    assert jan.player_id.startswith("jan-novak-") and jan.league == "Test League"
    k = by["Keeper One"]
    assert k.saves_per90 == 3.2 and k.goals_per_90 is None   # outfield labels do not map for keepers
    assert (k.appearances, k.goals) == (0, 0)                  # counters default to 0


def test_person_id_survives_collision_suffix(spark):
    same = PLAYER  # the same person scraped twice in one league (moved clubs)
    pages = spark.createDataFrame([(1, "https://site.example/players/a", same), (2, "https://site.example/players/b", same)],
                                  "page_id long, url string, html string")
    rec = records_from_pages(pages, "2023-03-01", league="L", keep_person_id=True).orderBy("player_id").collect()
    assert rec[0].person_id == rec[1].person_id
    assert {r.player_id for r in rec} == {rec[0].person_id, rec[0].person_id + "-1"}


ODD = """<html dir=ltr lang='de'><head><title data-x="1">Tom &amp; J&#233;r&#xF4;me &lt;3</title></head><body>
<a class="x" href='/p?a=1&amp;b=2' rel="me">Caf&eacute;? R&amp;D
 second line</a><A HREF="http://other.example/z">Z&nbsp;&quot;q&quot;</A>
<table class=t id='stats_scout_full_AM'><tr><th scope="row" data-stat='statistic'>Goals &amp; more</th><td class='r' data-stat='per90'>0.5</td></tr></table>
<ul><li class=a><b>One</b> <a data-k="1" href='/one'>uno</a></li><li>no link</li></ul></body></html>"""


def test_html_as_a_parser_reads_it(spark):
    page = spark.createDataFrame([(1, "https://s.example/dir/p", ODD)], "page_id long, url string, html string")
    links = [(r.pos, r.href, r.text, r.abs_url) for r in hx.extract_links(page).orderBy("pos").collect()]
    assert links == [
        (1, "/p?a=1&b=2", "Caf&eacute;? R&D\n second line", "https://s.example/p?a=1&b=2"),
        (2, "http://other.example/z", 'Z "q"', "http://other.example/z"),
        (3, "/one", "uno", "https://s.example/one"),
    ]
    f = hx.extract_fields(page).first()
    assert (f.title, f.lang) == ("Tom & Jérôme <3", "de")
    assert [(r.stat_label, r.per90) for r in hx.stat_pairs(page).collect()] == [("Goals & more", "0.5")]
    assert [(r.pos, r.text, r.href) for r in hx.extract_list_items(page).collect()] == [(1, "One uno", "/one")]


NESTED = """<html><head><link rel='stylesheet' href='/s.css'><link rel=icon href="/i.png"><script>var x = "<li><a href='/no'>no</a></li><!-- no -->";</script></head><body>
<!-- <li><a href="/hidden">hidden</a></li> --><h1 class='n'>Jos&eacute; &Ntilde;</h1>
<a class="flag" href='/en/country/ESP/'>Espa&ntilde;a</a><span data-birth='1999-01-02' id=necro-birth>x</span><span> 1,80 m </span><span>179cm</span> Position:&nbsp;MF
<ul><li>Outer <a href='/o'>A</a><ul><li><b><a class=x href="/i?a=1&amp;b=2">B &eacute;</a></b></li></ul></li><li>none</li><LI><A HREF='/up'>Up</A></LI></ul>
<table id='scout_full_X'><tbody><tr><th data-stat="statistic">Goals</th><td data-stat="note"><table><tr><th data-stat="statistic">Inner</th><td data-stat="per90">9</td></tr></table></td>
<td class='q' data-stat="per90">1.5</td></tr><tr><th scope=row data-stat='statistic'>Assists</th><td data-stat=per90>0.25</td></tr></tbody></table>
<table><tr class="thead x"><th>Head</th></tr><tr><td>1</td><td><table><tr><td>in</td></tr></table></td><td><a href='/r'>row</a></td></tr><track src=x></table></body></html>"""

CLUB_ODD = """<html><!-- <table class='t' id='stats_standard_1'><tr class='thead'><th data-stat='player'><a href='/h'>Head</a></th></tr>
<tr><th data-stat='player'><b><a class=p href='/p/1'>Zo&euml;</a></b></th><td data-stat='games'>3</td><td data-stat='xg'>0,5</td></tr>
<tr><th data-stat="player">No link</th></tr></table> --></html>"""


def _page(spark, html):
    return spark.createDataFrame([(1, "https://s.example/dir/p", html), (2, "https://s.example/", None), (3, "https://s.example/", "")], "page_id long, url string, html string")


def test_nested_tables_and_lists(spark):
    page = _page(spark, NESTED)
    assert [(r.pos, r.text, r.href) for r in hx.extract_list_items(page).orderBy("pos").collect()] == [(1, "Outer AB é", "/o"), (2, "B é", "/i?a=1&b=2"), (4, "Up", "/up")]
    assert [(r.stat_label, r.per90) for r in hx.stat_pairs(page).orderBy("pos").collect()] == [("Goals", "1.5"), ("Assists", "0.25")]
    rows = hx.extract_table_rows(page, require_link=False).orderBy("row_pos").collect()
    assert [r.cells for r in rows] == [["Goals", "Inner9", "1.5"], ["Inner", "9"], ["Assists", "0.25"], ["1", "in", "row"], ["in"]]
    assert [r.href for r in hx.extract_table_rows(page).collect()] == ["/r"]
    assert [r.comment for r in hx.extract_comments(page).collect()] == ['<li><a href="/hidden">hidden</a></li>']


def test_profile_and_club_with_any_quotes(spark):
    r = hx.profile_fields(_page(spark, NESTED)).where("page_id = 1").first()
    assert (r.player_name, r.nationality, r.dob, r.height, r.position, r.foot) == ("José Ñ", "España", "1999-01-02", 179.0, "MF", None)
    rows = [tuple(r) for r in hx.club_player_rows(_page(spark, CLUB_ODD)).collect()]
    assert rows == [(1, 2, "Zoë", "https://s.example/p/1", 3, None, None, None, 0.5, None)] or rows[0][:5] == (1, 2, "Zoë", "https://s.example/p/1", 3)
    assert hx.extract_fields(_page(spark, NESTED)).where("page_id > 1").select("title", "n_items").collect() == [(None, 0), (None, 0)]


def test_unclosed_and_stray_tags():
    from valuelens.sources.html_tree import parse

    t = parse("<div><p>a<p>b</div></b><i>c<br/>d")
    assert t.tag == ["div", "p", "p", "i", "br"] and t.parent == [-1, 0, 1, -1, 3]
    assert [t.text(i) for i in range(5)] == ["ab", "ab", "b", "cd", ""] and t.last == [2, 2, 2, 4, 4]
