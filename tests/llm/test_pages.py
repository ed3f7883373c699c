"""HTML text and WARC archives."""

import gzip
import hashlib
import random

import pytest

from zonecast.llm.html_text import ARTICLE, FURNITURE, PLAIN, blocks, common_lines, difference, extract_text
from zonecast.llm.order import with_position
from zonecast.llm.warc import read_warc, salvage, warc_records, write_warc


def test_blocks_of_a_messy_page():
    html = """<!DOCTYPE html><html><head><title>t</title><style>p{x}</style></head><body class="home">
      <nav><ul><li>Menu<li>More</ul></nav><div class="cookie-notice">We use <b>cookies</b></div>
      <header><h1>Site</h1></header><main><header><h1>Head&shy;line</h1></header><p>One&nbsp;&amp;\n two<br>three <i>i</i>n
      <p>Four<script>var a = "</p>";</script> five<!-- <p>no</p> --><div id="comments"><p>first!</p></div>
      <aside>side</aside><form>f<input></form><ul><li>a</li><li>b &lt;c&gt;</li></ul></main><footer>foot</footer> tail &#8364;"""
    got = blocks(html)
    assert [t for t, k in got if k == ARTICLE] == ["Head­line", "One & two three in", "Four five", "a", "b <c>"]
    assert [t for t, k in got if k == PLAIN] == ["tail €"]
    assert {t for t, k in got if k == FURNITURE} == {"Menu", "More", "We use cookies", "Site", "first!", "side", "f", "foot"}
    assert blocks("") == [] and blocks("just text") == [("just text", PLAIN)] and blocks("a < b") == [("a < b", PLAIN)]
    assert blocks("<p>x<style>never closed") == [("x", PLAIN)] and len(blocks("<div>" * 20000 + "deep")) == 1


def test_common_lines_are_a_longest_common_subsequence():
    rnd = random.Random(1)
    for _ in range(1500):
        a, b = ([rnd.randrange(5) for _ in range(rnd.randrange(10))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        kept = [x for x, m in zip(a, common_lines(a, b), strict=True) if m]
        it = iter(b)
        assert len(kept) == table[-1][-1] and all(x in it for x in kept)


def page_frame(spark, rows):
    return spark.createDataFrame([(p, u, h, 1, "x") for p, u, h in rows], "page_id long, url string, html string, n_chars int, text string")


def test_pages_without_marks_lose_what_their_neighbour_shares(spark):
    def page(own):
        return f"<body><div>Site slogan</div><div>Home | About</div><p>{own}</p><p>Subtle end line</p></body>"
    rows = [(1, "http://a.org/x/1", page("alpha")), (2, "http://a.org/x/2", page("beta")), (3, "http://a.org/y/9", page("gamma")),
            (4, "http://b.org/x/1", page("alone")), (5, "http://c.org/1", page("copy")), (6, "http://c.org/1", page("copy")),
            (7, "http://a.org/w/3", "<article><p>Site slogan</p></article><div>Home | About</div>"),
            (8, None, page("nowhere")), (9, "http://a.org/z", None), (10, "http://a.org/x/4", ""), (None, "::", "<p>odd</p>")]
    got = {r.page_id: (r.text, r.n_chars) for r in extract_text(page_frame(spark, rows)).collect()}
    whole = "Site slogan\nHome | About\n{}\nSubtle end line"
    assert got[1][0] == "alpha" and got[2][0] == "beta" and got[3][0] == "gamma"
    assert [got[i][0] for i in (4, 5, 6, 8)] == [whole.format(x) for x in ("alone", "copy", "copy", "nowhere")]
    assert got[7] == ("Site slogan", 11) and got[9] == ("", 0) and got[10] == ("", 0) and got[None] == ("odd", 3)
    assert extract_text(page_frame(spark, [])).count() == 0


def test_class_words_do_not_lose_the_article(spark):
    def page(body):
        return f"<body><div>Home | About</div>{body}<div class='site-footer'>Imprint</div></body>"
    rows = [(1, "http://a.org/1", page("<div class='post no-sidebar'><article><p>one</p></article></div>")),
            (2, "http://a.org/2", page("<div class='content has-comments'><article>two</article></div>")),
            (3, "http://a.org/3", page("<section id='social-policy'><article>three</article></section>")),
            (4, "http://b.org/1", page("<div class='post-title'>Title 4</div><div class='content'>four</div>")),
            (5, "http://b.org/2", page("<div class='post'>Title 5</div><div class='content'>five</div>")),
            (6, "http://b.org/3", page("<div class='post'>only a post</div>")),
            (7, "http://c.org/1", page("<div class='post'>Title 7</div><div class='content'>seven</div>")),
            (8, "http://c.org/1", page("<div class='post'>Title 7</div><div class='content'>seven</div>")),
            (9, "http://d.org/1", page("<div class='story'><h1>Title 9</h1><div class='entry-content'>nine</div></div><div>more</div>")),
            (10, "http://e.org/1", page("<div class='post'><header>Title 10</header><div class='related posts'>other</div>ten</div>"))]
    got = {r.page_id: r.text for r in extract_text(page_frame(spark, rows)).collect()}
    assert got == {1: "one", 2: "two", 3: "three", 4: "Title 4\nfour", 5: "Title 5\nfive", 6: "only a post",
                   7: "Home | About\nTitle 7\nseven", 8: "Home | About\nTitle 7\nseven", 9: "Title 9\nnine",
                   10: "Home | About\nTitle 10\nten"}


def test_furniture_on_blocks_that_are_no_containers():
    html = """<article><p class='advert'>buy<p>one<ul><li class=related>see<li>two</li></ul><table><tr><td class='ad'><p>x</p><p>y</p><td>three
      </table><h2 class="sponsored">z</h2>four<blockquote class="promo"><p>q</p></blockquote>five<ul><li class="ad"><ul><li>in</li></ul>on</ul>six
      <p class="intro">seven</p></article><article class='comment'>first!</article><article class="post no-comments">eight</article>"""
    got = blocks(html)
    assert [t for t, k in got if k == ARTICLE] == "one two three four five six seven eight".split()
    assert [t for t, k in got if k == FURNITURE] == ["buy", "see", "x", "y", "z", "q", "in", "on", "first!"]


def test_inline_furniture_and_text_that_is_not_dropped():
    html = """<article><p>One <span class="ad">Buy <span>now</span>!</span> two <math><mi>x</mi>=<mn>2</mn></math> <object>three</object><img class="ad"> four
      <p>five <a class="share" href="x">Share<p>six</a> seven</article><div>eight</div><button>b</button><select><option>o</select>"""
    got = blocks(html)
    assert [t for t, k in got if k == ARTICLE] == ["One two x=2 three four", "five", "seven"]
    assert [t for t, k in got if k == FURNITURE] == ["Buy now!", "Share", "six"] and [t for t, k in got if k == PLAIN] == ["eight"]
    assert blocks("<article><p>a<span class='ad'>b</p><p>c</p></article>d") == [("a", ARTICLE), ("b", FURNITURE), ("c", ARTICLE), ("d", PLAIN)]


def test_markup_that_never_ends_is_read_in_linear_time():
    import time
    pieces = ["a <b ", "<p class=\"x ", "<a href='", "<!-- x ", "<textarea>", "<span class='ad'>x", "<div class=ad>y", "<", "</", "<!x ", "<a b='>", "&amp "]
    for piece in pieces:
        for end in ("", ">", "\">", "'>"):
            begin = time.process_time()
            blocks(piece * (1_000_000 // len(piece)) + end)
            assert time.process_time() - begin < 4, piece
    assert blocks("x <b y") == [("x <b y", PLAIN)] and blocks("<p class=\"x>one</p>") == [("one", PLAIN)]
    assert blocks("1 < 2 <3 <b>4</b>") == [("1 < 2 <3 4", PLAIN)]


def lcs_marks(a, b):
    """How many items of ``a`` and ``b`` a longest common subsequence has, by table."""
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_differencing_decides_and_markup_settles_conflicts(spark):
    """Against lines compared by table, on pages with distinct lines (so that the subsequence is unique)."""
    rnd = random.Random(6)
    site = [f"site line {i}" for i in range(12)]
    rows, lines = [], {}
    for p in range(40):
        own = [f"own {p} {i}" for i in range(rnd.randrange(1, 6))]
        have = sorted(rnd.sample(range(12), rnd.randrange(3, 9)))
        parts = [("div", site[i]) for i in have] + [(rnd.choice(["p", "article", "nav"]), t) for t in own] + [("article", "An article's own repeated line")]
        rnd.shuffle(parts)
        rows.append((p, f"http://h.org/{p:03d}", "".join(f"<{t}>{x}</{t}>" for t, x in parts)))
        lines[p] = parts
    got = {r.page_id: r for r in difference(page_frame(spark, rows)).collect()}
    changed = 0
    for p, parts in lines.items():
        texts = [x for _, x in parts]
        near = [[x for _, x in lines[q]] for q in (p - 1, p + 1) if q in lines]
        text = got[p].text.split("\n")
        kept = [x for t, x in parts if x in text]
        assert kept == text                                                             # in order
        assert {x for t, x in parts if t == "article"} <= set(text) and not {x for t, x in parts if t == "nav"} & set(text)
        assert {x for t, x in parts if t == "p"} <= set(text)
        plain = [x for t, x in parts if t == "div"]
        gone = [x for x in plain if x not in text]
        assert all(any(x in n for n in near) for x in gone)                             # only what a neighbour has
        assert got[p].n_shared >= max(lcs_marks(texts, n) for n in near) and got[p].n_lines == len(parts)
        assert got[p].n_restored == 1 or all(lcs_marks(texts, n) < len(texts) for n in near)
        changed += bool(gone)
    assert changed > 30                                                                 # pages that would read otherwise without it


def test_positions_follow_the_order(spark):
    rows = [(i * 37 % 101, "k") for i in range(101)]
    got = with_position(spark.createDataFrame(rows, "a long, b string").repartition(7), "a", name="t").collect()
    assert [r.pos for r in sorted(got, key=lambda r: r.a)] == list(range(101))


# -------------------------------------------------------------------- WARC ---

BIG = "<html>" + "é" * 600 + "</html>"


def archive(spark, rows):
    return [(r.value + "\n").encode() for r in warc_records(page_frame(spark, rows)).collect()]


def test_round_trip_and_revisits(spark, tmp_path):
    rows = [(1, "http://a/", BIG), (5, "http://b/", BIG), (3, None, BIG), (None, "u", BIG), (2, "s", "small"), (4, "t", "small"),
            (6, "x", None), (7, "y\r\nWARC/1.1", "WARC/1.1\r\nWARC-Type: response\r\n\r\n\r\n"), (8, "big", "line\r\n\r\n" * 40000), (5, "http://b/", BIG)]
    path = str(tmp_path / "w")
    write_warc(page_frame(spark, rows), path)
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.type, r.refers_to) for r in read_warc(spark, path).collect()), key=str)
    want = []
    for p, _, h in rows:
        raw = (h or "").encode()
        again = h == BIG and p is not None and p < 5
        want.append((p, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", 5 if again else None))
    assert got == sorted(want, key=str)
    assert {r.reason for r in read_warc(spark, path).collect()} == {None}
    empty = str(tmp_path / "e")
    write_warc(page_frame(spark, []), empty)
    assert read_warc(spark, empty).count() == 0


@pytest.mark.parametrize("packed", [False, True])
def test_salvage_recovers_later_records_and_logs_gaps(spark, packed):
    parts = archive(spark, [(i, f"http://h/{i}", f"<p>page {i}</p>" * (i + 1)) for i in range(8)])
    order = sorted(parts, key=lambda p: int(p.split(b"WARC-Page-ID: ")[1].split(b"\r")[0]))
    if packed:
        order = [gzip.compress(p, mtime=0) for p in order]
    good = [r for r in salvage(b"".join(order))]
    assert [r[2]["page_id"] for r in good] == list(range(8)) and good[-1][1] == sum(map(len, order))

    broken = [bytearray(p) for p in order]
    broken[1][-8] ^= 0xFF                                     # a flipped byte of the payload, or of the member's checksum
    del broken[3][-20:]                                       # cut
    broken[5][:6] = b"NOTHIN"                                 # no version line, no member
    data = b"junk\r\n" + b"".join(broken)
    found = list(salvage(data))
    # the byte flipped in a member is one of its checksum: the record itself has a digest that vouches for it
    assert [r[2]["page_id"] for r in found if isinstance(r[2], dict)] == ([0, 1, 2, 4, 6, 7] if packed else [0, 2, 4, 6, 7])
    gaps = [(a, b) for a, b, r in found if isinstance(r, str)]
    assert gaps[0] == (0, 6) and len(gaps) == 4
    covered = sorted({(a, b) for a, b, _ in found})
    assert covered[0][0] == 0 and covered[-1][1] == len(data) and all(x[1] == y[0] for x, y in zip(covered, covered[1:], strict=False))
    assert list(salvage(b"")) == [] and list(salvage(b"xyz"))[0][:2] == (0, 3)


def records_of(spark, n):
    parts = archive(spark, [(i, f"http://h/{i}", f"<p>page {i}</p>" * 30) for i in range(n)])
    return sorted(parts, key=lambda p: int(p.split(b"WARC-Page-ID: ")[1].split(b"\r")[0]))


def pages_of(found):
    return [r["page_id"] for _, _, r in found if isinstance(r, dict)]


def test_records_inside_broken_members_are_recovered(spark):
    parts = records_of(spark, 5)
    bad = bytearray(parts[2])
    bad[-30] ^= 0xFF                                          # in the payload: its digests fail
    plain = b"".join([*parts[:2], bytes(bad), *parts[3:]])
    found = list(salvage(gzip.compress(plain, mtime=0)))
    assert pages_of(found) == [0, 1, 3, 4] and sum(isinstance(r, str) for _, _, r in found) == 1
    assert pages_of(salvage(plain)) == [0, 1, 3, 4]
    inner = [r["inner"] for _, _, r in found if isinstance(r, dict)]
    assert inner == [0, len(parts[0]), len(plain) - len(parts[3]) - len(parts[4]), len(plain) - len(parts[4])]

    whole = gzip.compress(b"".join(parts), mtime=0)
    after = gzip.compress(records_of(spark, 7)[6], mtime=0)
    cut = whole[:-60] + after                                  # the stream breaks off before its end
    assert pages_of(salvage(cut))[:3] == [0, 1, 2] and pages_of(salvage(cut))[-1] == 6
    crc = bytearray(whole)
    crc[-8] ^= 1
    found = list(salvage(bytes(crc) + after))
    assert pages_of(found) == [0, 1, 2, 3, 4, 6] and [r for _, _, r in found if isinstance(r, str)] == ["gzip: checksum differs"]
    named = bytearray(gzip.compress(parts[0], mtime=0))
    named[3] |= 8
    assert pages_of(salvage(bytes(named[:10]) + b"name\0" + bytes(named[10:]))) == [0]


def test_nothing_without_a_digest_comes_out_of_a_broken_member(spark):
    import re as regex
    part = regex.sub(rb"WARC-(Block|Payload)-Digest: [^\r]*\r\n", b"", records_of(spark, 1)[0])
    packed = bytearray(gzip.compress(part, mtime=0))
    assert pages_of(salvage(bytes(packed))) == [0]
    packed[-8] ^= 1
    assert pages_of(salvage(bytes(packed))) == []


def test_salvage_of_any_damage_covers_the_archive(spark):
    rnd = random.Random(4)
    parts = records_of(spark, 6)
    for packed in (False, True):
        data = b"".join(gzip.compress(p, mtime=0) if packed else p for p in parts)
        for _ in range(40):
            broken = bytearray(data)
            for _ in range(rnd.randrange(1, 4)):
                a = rnd.randrange(len(broken))
                if rnd.random() < 0.5:
                    broken[a] ^= 1 << rnd.randrange(8)
                else:
                    del broken[a:a + rnd.randrange(200)]
            found = list(salvage(bytes(broken)))
            places = sorted({(a, b) for a, b, _ in found})
            assert places[0][0] == 0 and places[-1][1] == len(broken) and all(x[1] == y[0] for x, y in zip(places, places[1:], strict=False))
            ids = [i for i in pages_of(found) if i is not None]              # a flipped bit may lie in the name of that header
            assert len(pages_of(found)) >= 2 and (len(ids) < len(pages_of(found)) or ids == sorted(set(ids)))


def test_archives_are_bounded(spark, tmp_path):
    import os
    rows = [(i, f"http://h/{i}", "x" * (i % 7 * 300)) for i in range(200)] + [(900 + i, "u", "L" * 30000) for i in range(4)] + [(999, None, "M" * 90000)]
    path = str(tmp_path / "w")
    write_warc(page_frame(spark, rows).repartition(1), path, archive_bytes=80_000, large=20_000)
    sizes = sorted(os.path.getsize(os.path.join(path, f)) for f in os.listdir(path) if f.startswith("part-"))
    assert sizes[-1] > 90000 and sizes[-2] <= 80_000 and len(sizes) < 80
    assert sorted(r.page_id for r in read_warc(spark, path).collect()) == sorted(r[0] for r in rows)
    few = str(tmp_path / "few")
    write_warc(page_frame(spark, rows[:200]).repartition(1), few)
    assert sum(f.startswith("part-") for f in os.listdir(few)) <= 8          # one a task
