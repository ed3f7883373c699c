import pytest

from zonecast.operators.links import (anchor_hrefs, extract_trip_data_links, filter_links, sort_links)

BASE = "https://files.example.org/trip-data"


def pages(spark, *htmls):
    return spark.createDataFrame(list(enumerate(htmls)), "page_id bigint, html string")


def links(spark, *htmls):
    return [(r.taxi_type, r.year, r.month, r.url)
            for r in sort_links(extract_trip_data_links(pages(spark, *htmls))).collect()]


def test_blank_and_anchorless_pages(spark):
    assert links(spark, "", "   ", "<p>no links</p>", "<a>no href</a>") == []


def test_types_order_and_noise(spark):
    html = f"""<ul>
      <li><a href="{BASE}/yellow_tripdata_2024-02.parquet">y</a></li>
      <li><a href=' {BASE}/FHVHV_tripdata_2024-01.parquet '>h</a></li>
      <li><a href="{BASE}/green_tripdata_2023-12.parquet">g</a></li>
      <li><a href="{BASE}/fhv_tripdata_2024-01.parquet">f</a></li>
      <li><a href="https://example.com/about">other</a></li>
      <li><a href="{BASE}/yellow_tripdata_2024-01.csv">csv</a></li>
    </ul>"""
    got = links(spark, html)
    assert got == [("fhv", 2024, 1, f"{BASE}/fhv_tripdata_2024-01.parquet"),
                   ("fhvhv", 2024, 1, f"{BASE}/FHVHV_tripdata_2024-01.parquet"),
                   ("green", 2023, 12, f"{BASE}/green_tripdata_2023-12.parquet"),
                   ("yellow", 2024, 2, f"{BASE}/yellow_tripdata_2024-02.parquet")]


def test_duplicates_keep_first(spark):
    a = f'<a href="{BASE}/green_tripdata_2024-03.parquet">x</a>'
    df = extract_trip_data_links(pages(spark, a + a, a))
    rows = df.collect()
    assert len(rows) == 1 and (rows[0].page_id, rows[0].pos) == (0, 0)


def test_comments_scripts_entities(spark):
    html = (f'<!-- <a href="{BASE}/green_tripdata_2020-01.parquet">old</a> -->'
            f'<script>var s = \'<a href="{BASE}/green_tripdata_2020-02.parquet">\';</script>'
            '<a data-href="x" href="https://h.example/a?x=1&amp;y=2">e</a>')
    hrefs = [r.href for r in anchor_hrefs(pages(spark, html)).collect()]
    assert hrefs == ["https://h.example/a?x=1&y=2"]


def test_non_text_html_rejected(spark):
    with pytest.raises(ValueError):
        anchor_hrefs(spark.createDataFrame([(1, 2)], "page_id bigint, html int"))


@pytest.fixture
def six(spark):
    rows = [("yellow", 2024, 1), ("yellow", 2024, 2), ("green", 2024, 1), ("fhvhv", 2023, 12),
            ("fhvhv", 2024, 1), ("fhv", 2024, 3)]
    return spark.createDataFrame([(t, y, m, f"{BASE}/{t}_tripdata_{y}-{m:02d}.parquet", 0, i)
                                  for i, (t, y, m) in enumerate(rows)],
                                 "taxi_type string, year int, month int, url string, page_id bigint, pos int")


def test_filters(six):
    assert filter_links(six, taxi_types=["FHVHV"]).count() == 2
    assert filter_links(six, year=2024).count() == 5
    assert filter_links(six, months=[1]).count() == 3
    got = filter_links(six, taxi_types=["yellow", "fhvhv"], year=2024, months=[1])
    assert sorted(r.taxi_type for r in got.collect()) == ["fhvhv", "yellow"]
    assert filter_links(six).count() == 6
    with pytest.raises(ValueError):
        filter_links(six, taxi_types=["bus"])
    with pytest.raises(ValueError):
        filter_links(six, months=[13])
    with pytest.raises(ValueError):
        filter_links(six, months=[1.5])


def test_white_space_quotes_and_references(spark):
    html = ("""<a href="\n https://h.example/1\t">1</a><a title="a>b" href='https://h.example/2'>2</a>"""
            """<a href="https:&#47;&#x2F;h.example/3&#8364;">3</a><a data-x='href="no"' href=https://h.example/4>4</a>"""
            """<a title='href="https://h.example/no"'>n</a><a href="/x?a=1&amp;lt=2">5</a><a href="&amp;#47;">6</a>"""
            """<a href="\u00a0/nbsp&nbsp;">7</a><a href="">8</a><a\nhref\n=\n"/9">9</a>""")
    hrefs = [r.href for r in anchor_hrefs(pages(spark, html)).orderBy("pos").collect()]
    assert hrefs == ["https://h.example/1", "https://h.example/2", "https://h.example/3\u20ac", "https://h.example/4",
                     "/x?a=1&lt=2", "&#47;", "/nbsp", "/9"]


def test_very_long_attributes_do_not_overflow(spark):
    html = '<a title="' + "x>" * 200_000 + '" href="/far">f</a><a ' + "b " * 20_000 + 'href="/many">m</a>'
    assert [r.href for r in anchor_hrefs(pages(spark, html)).orderBy("pos").collect()] == ["/far", "/many"]
