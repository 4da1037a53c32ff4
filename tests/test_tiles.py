"""Tiles of list pages, well formed and not."""

from pyspark.sql import functions as F

from tidemark.sources import tiles

GERMAN = """<ul class="list">
<LI class='x listeneintrag ba-tile' id=a><a href="/jobsuche/jobdetail/10000-1-S/?x=1">Welder &amp; more</a>
  <ul><li>one</li><li>two <a href="/other">o</a></li></ul>
  <span title="Veröffentlichungsdatum: 15.08.2026">neu</span><span id="e-0-arbeitsort"> Arbeitsort: <b>Bad&nbsp;Tölz</b> (11 km)</span></LI>
<li class="ba-tile">not an entry <a href="/jobsuche/jobdetail/no">x</a></li>
<li class="ba-tile listeneintrag"><a href='/elsewhere'>no id</a></li>
<li class="ba-tile listeneintrag"><a href=/jobsuche/jobdetail/10000-2-S>bare</a><span title='Veröffentlichungsdatum: 31.02.2026'></span>
<li data-x="1" class="ba-tile listeneintrag" ><a class="l" href="/jobsuche/jobdetail/10000-3-S">open</a><span id="x-arbeitsort">Ort: Kiel</span>"""
FLEMISH = """<div class="numbers-job">Er zijn <strong> 1.627 </strong> jobs gevonden</div>
<div class="product-tile wide"><div><a href="/x"></a><a href="https://www.vdab.be/vindeenjob/vacatures/4711/lasser">Lasser</a></div><p class="small online-sinds">Online   sinds  <i>15 aug.</i>
 2026</p></div><div class="other"><a href="/vindeenjob/vacatures/1/x">no tile</a></div>
<div class="product-tile"><a href="/vindeenjob/vacatures/abc/">bad id</a></div><div class="product-tiles">no</div>"""


def pages(spark, *bodies):
    return spark.createDataFrame(list(enumerate(bodies)), "page int, html string")


def test_german_tiles(spark):
    found = tiles.german_tiles(pages(spark, GERMAN, None, "", "<li class="), "page").orderBy("page", "place").collect()
    assert [(r.place, r.native_id, str(r.first_published), r.location_city) for r in found] == [(0, "10000-1-S", "2026-08-15", "Bad Tölz"), (2, "10000-2-S", "None", None), (3, "10000-3-S", "None", None)]


def test_flemish_tiles(spark):
    table = pages(spark, FLEMISH, None, "<strong>5</strong>")
    assert [tuple(r) for r in tiles.flemish_tiles(table, "page").orderBy("place").collect()] == [(0, 0, "4711", "Online sinds 15 aug. 2026"), (0, 1, None, None)]
    assert sorted(map(tuple, tiles.landing_pages(table, "page").collect())) == [(0, 1627, 1, 1), (1, None, 0, 0), (2, None, 0, 0)]


def test_elements_close_where_they_close(spark):
    html = '<div class="t">a<div>b<DIV>c</DIV></div>d</div>e<div class="t u">f<div class="t">inner</div>g</div><div class="T">h</div><divider class="t">i</divider>'
    found = pages(spark, html).select(tiles.elements(F.col("html"), "div", "t").alias("e")).first().e
    assert found == ['<div class="t">a<div>b<div>c</div></div>d', '<div class="t u">f', '<div class="t">inner']
    assert pages(spark, '<p class="x">1</p><P>2').select(tiles.elements(F.col("html"), "p").alias("e")).first().e == ['<p class="x">1', "<p>2"]


def test_plans_stay_inside_the_engine(spark):
    assert "Python" not in tiles.german_tiles(pages(spark, GERMAN), "page")._jdf.queryExecution().toString()
