"""op6 and op8: round trips of archives, main texts of small templates."""

import gzip
import hashlib
import os
import random
import zlib

import pytest

from loopcount.llm import html, warc

BIG = "<p>" + "x" * 200 + "</p>"


def digests(rows):
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        same = [j for j, _, other in rows if (other or "") == (h or "") and j is not None]
        first = min(same) if same and len(raw) >= 100 else None
        to = first if first is not None and first != i else None
        out.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


def test_round_trip(pages):
    rows = [(1, "http://a/x", BIG), (2, "http://a/y", BIG), (3, None, BIG), (4, "http://b/ü\r\nX: y", "small"), (5, "u", "small"), (6, "u", None), (7, "u", ""),
            (None, "u", BIG), (8, "u", "ünï \x00 ≤" * 400_000), (9, "u", "WARC/1.1\r\n\r\n" * 20), (10, "u", BIG + "1"), (10, "u", BIG + "1")]
    got = sorted(map(tuple, warc.round_trip(pages(rows)).collect()), key=str)
    assert got == digests(rows)
    assert warc.round_trip(pages([])).count() == 0


def test_files_are_plain_gzip_and_keep_urls_and_payloads(spark, pages, tmp_path):
    path = str(tmp_path / "archive")
    warc.write_archives(pages([(1, "http://a/?q=1#f", BIG), (2, "http://a/b c", BIG), (3, None, "t")]).coalesce(1), path)
    raw = b"".join(open(os.path.join(path, f), "rb").read() for f in os.listdir(path) if f.startswith("part"))
    assert gzip.decompress(raw).count(b"WARC/1.1\r\n") == 3
    got = {r["page_id"]: (r["url"], r["payload"]) for r in warc.read_archives(spark, path).collect()}
    assert got == {1: ("http://a/?q=1#f", bytearray(BIG.encode())), 2: ("http://a/b%20c", None), 3: (None, bytearray(b"t"))}


@pytest.mark.parametrize("size", ["700", "4k", "50k", "10m"])
def test_members_that_hold_the_magic_and_junk_between(spark, tmp_path, size):
    rnd, want = random.Random(1), {}
    for f in range(2):
        out = b""
        for i in range(f * 100, f * 100 + 40):
            parts = [warc.MAGIC, b"\x1f\x8b\x08\0\0\0\0\0\0\x03", b"abc", rnd.randbytes(50), warc.gzip_member(b"hello"), warc.gzip_member(b"")]
            body = b"".join(rnd.choice(parts) for _ in range(rnd.randint(0, 120)))
            packer = zlib.compressobj(rnd.choice((0, 0, 6)), zlib.DEFLATED, 31)
            out += packer.compress(warc.record(i, "http://x/", body, "", None)) + packer.flush() + (b"junk" if rnd.random() < 0.1 else b"")
            want[i] = (len(body), hashlib.sha256(body).hexdigest())
        (tmp_path / f"a{f}.warc").write_bytes(out)
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    try:
        spark.conf.set(names[0], size)
        spark.conf.set(names[1], "1")
        rows = warc.read_archives(spark, str(tmp_path)).collect()
    finally:
        for name in names:
            spark.conf.unset(name)
    assert len(rows) == len(want) and {r["page_id"]: (r["payload_bytes"], r["payload_digest"]) for r in rows} == want


def test_a_damaged_member_costs_only_itself(spark, tmp_path):
    members = [warc.gzip_member(warc.record(i, "u", b"y" * 500 + bytes([i]), "", None)) for i in range(5)]
    members[2] = members[2][:len(members[2]) // 2]
    (tmp_path / "a.warc").write_bytes(b"".join(members))
    assert sorted(r["page_id"] for r in warc.read_archives(spark, str(tmp_path)).collect()) == [0, 1, 3, 4]


# --- main text --------------------------------------------------------------------------


def page(i, body, tag="article"):
    return (f"<!DOCTYPE html><html><head><title>t{i}</title><style>p{{}}</style><script>var a='</p><p>no';</script></head><body><nav><ul><li><a>m{i}</a><li>x</ul></nav>"
            f"<div class='ad-slot'>buy {i}</div><{tag}><h1>Head &amp; {i}</h1>{body}<form>mail <input></form><section id=comments>c{i}</section></{tag}><footer>&copy; {i}</footer></body></html>")


BODY = "<p>First   one <b>bold</b>\n text<br>more<p>Second &lt;two&gt; é<!-- no <p>x -->{}<ul><li>a{}<li>b</ul>"


def text(i):
    return f"Head & {i}\nFirst one bold text more\nSecond <two> é{i}\na{i}\nb"


def test_main_text_of_article_and_of_unnamed_blocks(pages):
    rows = [(i, "http://h.example/a", page(i, BODY.format(i, i))) for i in range(6)]
    # On this host nothing is named: the wrapper learns that the notice repeats and where the mass is.
    plain = lambda i: f"<body><div class=a>Stay in touch<br>always</div><div class=b><h2>Title {i}</h2><p>{'word%d ' % i * 40}</div><div class=c>id{i}</div>"
    rows += [(100 + i, "https://user@plain.example:80/x", plain(i)) for i in range(8)]
    rows += [(200, None, None), (201, "", ""), (202, "http://one/", "<p>lone</p> text"), (203, "http://one/", "<nav>only</nav><script>x"), (None, "http://h.example/b", page(9, "<p>n")), (5, "http://h.example/a", page(5, BODY.format(5, 5)))]
    got = [(r["page_id"], r["text"], r["n_chars"]) for r in html.extract(pages(rows)).collect()]
    assert len(got) == len(rows) and all(n == len(t) for _, t, n in got)
    by = {i: t for i, t, _ in got}
    assert all(by[i] == text(i) for i in range(6)) and sum(i == 5 for i, *_ in got) == 2
    assert all(by[100 + i] == f"Title {i}\n" + " ".join([f"word{i}"] * 40) for i in range(8))
    assert (by[200], by[201], by[202], by[203], by[None]) == ("", "", "lone\ntext", "", "Head & 9\nn")
    assert html.extract(pages([])).count() == 0


def test_copies_of_one_page_are_no_template(pages):
    rows = [(i, "http://same/", page(1, "<p>copied</p>", "div")) for i in range(30)] + [(50, "http://same/", page(2, "<p>other</p>", "div"))]
    got = {r["page_id"]: r["text"] for r in html.extract(pages(rows)).collect()}
    assert set(got.values()) == {"Head & 1\ncopied", "Head & 2\nother"} and got[50].endswith("other")


def test_title_and_lead_beside_a_heavy_inner_container(pages):
    long = lambda i: " ".join([f"word{i}"] * 80)
    inner = {"body": "<div class=body><p>{}</p></div>", "list": "<ul><li>{}</li></ul>", "quote": "<blockquote>{}</blockquote>",
             "table": "<table><tr><td>{}</table>", "section": "<section>{}</section>"}
    rows, want = [], {}

    def add(host, source, text):
        rows.append((len(rows), f"http://{host}/", source))
        want[len(rows) - 1] = text

    for name, form in inner.items():
        for open_, close, host in (("<article>", "</article>", "marked"), ("<div class=post>", "</div>", "plain"), ("", "", "bare")):
            for i in range(5):
                source = f"<body><div>Same all over</div>{open_}<h1>T{i}</h1><p>lead {i}</p>{form.format(long(i))}{close}</body>"
                add(f"{name}.{host}", source, f"T{i}\nlead {i}\n{long(i)}")
            # Laid out elsewhere, with one block where the others have their text.
            source = f"<body><div>Same all over</div>{open_}<h1>T9</h1>{close}<main><h2>Odd</h2><p>other place</p></main></body>"
            add(f"{name}.{host}", source, "T9\nOdd\nother place")
            source = f"<body>{open_}<h1>T8</h1>{close}<div class=new><p>new place {long(8)}</p></div></body>"
            add(f"{name}.{host}", source, f"T8\nnew place {long(8)}")
    got = {r["page_id"]: r["text"] for r in html.extract(pages(rows)).collect()}
    assert got == want


def test_broken_markup():
    assert html.main_text("<div><p>a<div>b</p>c</span><p title='>'>d<td>e<!-- open") == "a\nb\nc\nd\ne"
    assert html.main_text("<script>never ends <p>x") == ""
    assert html.main_text("a < b & c <3 <p/>d") == "a < b & c <3\nd"
    assert html.main_text("<b>" * 5000 + "deep" + "</b>" * 5000) == "deep"
    assert html.main_text("<ul><li>a<ul><li>b</ul><li>c</ul><p>x" * 3).split("\n") == ["a", "b", "c", "x"] * 3


def test_simple_tree_matching_keeps_the_order():
    a = ("r", (("x", ()), ("y", (("z", ()),)), ("w", ())))
    b = ("r", (("y", (("z", ()), ("q", ()))), ("x", ())))
    size, pairs = html.simple_tree_matching(a, b)
    assert size == 3 and set(pairs) == {(("r",), ("r",)), (("r", "y"), ("r", "y")), (("r", "y", "z"), ("r", "y", "z"))}
    assert html.read_skeleton(html.write_skeleton(a)) == a
    assert html.simple_tree_matching(a, ("s", ()))[0] == 0


PROBES = [
    ("<h2 id='related-work'>Related work</h2>", "Related work"), ("<p class='side-effects'>Side effects</p>", "Side effects"),
    ("<section id='legal-analysis'>Legal analysis</section>", "Legal analysis"), ("<div class='search-algorithm'>Search algorithm</div>", "Search algorithm"),
    ("<h3 id='comments'>A heading's anchor</h3>", "A heading's anchor"), ("<p class='notice'>A paragraph</p>", "A paragraph"),
    ("<div class='notice'>A box of the article {i}</div>", "A box of the article {i}"), ("<div class='ad'>buy</div>", None), ("<div class='ad-slot-2'>buy</div>", None),
    ("<section id=comments><p>reader {i}</p></section>", None), ("<div class='related-posts'><a>other {i}</a> <a>more</a></div>", None),
    ("<div class='notice'>Terms apply everywhere</div>", None), ("<div role='navigation'>up</div>", None), ("<div class='share-buttons'>send</div>", None)]


def test_names_that_only_contain_a_part_are_kept(pages):
    body = "".join(p for p, _ in PROBES)
    rows = [(i, "http://probe/", f"<body><article><h1>Title {i}</h1>" + body.replace("{i}", str(i)) + f"<p>{'text%d ' % i * 30}</p></article>") for i in range(6)]
    expected = lambda i: "\n".join([f"Title {i}"] + [t.replace("{i}", str(i)) for _, t in PROBES if t] + [" ".join([f"text{i}"] * 30)])
    got = {r["page_id"]: r["text"] for r in html.extract(pages(rows)).collect()}
    assert got == {i: expected(i) for i in range(6)}
    # Without a wrapper only what repeats stays in doubt.
    assert html.main_text(rows[0][2]) == expected(0).replace(f"\n{expected(0).splitlines()[-1]}", f"\nTerms apply everywhere\n{expected(0).splitlines()[-1]}")


def test_names(pages):
    for name in ("ad", "ads", "ad-slot", "cookie_notice", "share-buttons", "comment-list", "nav", "post-comments", "breadcrumbs"):
        assert html.named(name) == 2, name
    for name in ("related", "footer-links", "side_bar", "search", "skip-to-content"):
        assert html.named(name) == 1, name
    for name in ("related-work", "side-effects", "legal-analysis", "search-algorithm", "adult", "shared-memory", "article", "content", "main-text", "12", ""):
        assert html.named(name) == 0, name


def test_a_form_around_the_page_is_a_container(pages):
    page = lambda i: (f"<body><form id=aspnet><input type=hidden value=x><div class=top>menu</div><h1>Head {i}</h1><p>{'one%d ' % i * 20}</p><p>two {i}</p>"  # noqa: E731
                      f"<form><p>Your mail <input></p><button>Send</button></form></form>")
    assert html.main_text(page(1)).split("\n")[-3:] == ["Head 1", " ".join(["one1"] * 20), "two 1"]
    got = {r["page_id"]: r["text"] for r in html.extract(pages([(i, "http://form/", page(i)) for i in range(8)])).collect()}
    assert got == {i: f"Head {i}\n" + " ".join([f"one{i}"] * 20) + f"\ntwo {i}" for i in range(8)}
    assert html.main_text("<form><article><p>in</article><select><option>no</select></form><p>out out out out") == "in"
    assert html.main_text("<p>text of a page</p><form><p>Name</p><input></form>") == "text of a page"
    assert html.main_text("<body><form>mail <input></form>") == ""


def brute_text(source):
    """The blocks of the marked article by the standard library's parser, for well-formed pages."""
    from html.parser import HTMLParser

    class Reader(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.depth, self.hidden, self.out, self.now = 0, 0, [], ""

        def flush(self):
            text = " ".join(self.now.split())
            self.now = ""
            if text:
                self.out.append(text)

        def handle_starttag(self, tag, attrs):
            if tag in html.VOID:
                self.now += " " if tag == "br" else ""
                return
            if tag in html.BLOCK:
                self.flush()
            self.depth += tag == "article"
            self.hidden += bool(self.hidden) or tag in html.NO_CONTENT or ("class", "ad") in attrs

        def handle_endtag(self, tag):
            if tag in html.BLOCK:
                self.flush()
            self.depth -= tag == "article"
            self.hidden -= bool(self.hidden)

        def handle_data(self, data):
            if self.depth and not self.hidden:
                self.now += data

    reader = Reader()
    reader.feed(source)
    reader.close()
    return "\n".join(reader.out)


def random_page(rnd, i):
    word = lambda: rnd.choice(["alpha", "b&amp;c", "&lt;x&gt;", "é", "中文", "&#8211;", "d\n e", "  f"]) + str(rnd.randrange(1000))
    words = lambda: " ".join(word() for _ in range(rnd.randint(1, 9)))

    def inline():
        return rnd.choice([words(), f"<b>{words()}</b> {word()}", f"{word()}<br>{word()}", f"{word()} <!-- <p>no</p> --><a href='/x'>{word()}</a>", f"<i>{word()}</i>"])

    def part(depth):
        kind = rnd.choice(["p", "p", "h2", "ul", "div", "section", "blockquote", "aside", "script", "ad", "table"])
        if kind in ("p", "h2"):
            return f"<{kind}>{inline()}</{kind}>"
        if kind == "ul":
            return "<ul>" + "".join(f"<li>{inline()}</li>" for _ in range(rnd.randint(1, 3))) + "</ul>"
        if kind == "table":
            return "<table><tbody><tr>" + "".join(f"<td>{inline()}</td>" for _ in range(2)) + "</tr></tbody></table>"
        if kind == "script":
            return "<script>var p = '</p><article>';</script>"
        if kind == "ad":
            return f"<div class=\"ad\">{inline()}</div>"
        inner = "".join(part(depth + 1) for _ in range(rnd.randint(1, 3))) if depth < 3 else f"<p>{inline()}</p>"
        return f"<{kind}>{inner}</{kind}>"

    body = "".join(part(0) for _ in range(rnd.randint(1, 12)))
    return (f"<!DOCTYPE html><html><head><title>{word()}</title></head><body><nav><ul><li>{word()}</li></ul></nav><div class=\"ad\">{words()}</div>"
            f"<article><h1>{words()} {i}</h1>{body}</article><footer>{words()}</footer></body></html>")


def test_equals_a_plain_extractor_on_marked_pages(pages):
    rnd = random.Random(3)
    rows = [(i, "http://random/", random_page(rnd, i)) for i in range(120)]
    got = {r["page_id"]: r["text"] for r in html.extract(pages(rows)).collect()}
    assert got == {i: brute_text(h) for i, _, h in rows}


def test_a_very_long_page(pages):
    parts = [f"<p>part {i} {'x' * 50}</p>" for i in range(60_000)]
    rows = [(1, "http://long/", "<article>" + "".join(parts) + "</article><footer>no</footer>"), (2, "http://long/", "<p>short")]
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html.extract(pages(rows)).collect()}
    text = "\n".join(f"part {i} {'x' * 50}" for i in range(60_000))
    assert got == {1: (text, len(text)), 2: ("short", 5)}


def test_lookups_are_shuffled_where_they_are_too_large_to_broadcast(pages, monkeypatch):
    monkeypatch.setattr(html, "BROADCAST_BYTES", 0)
    rows = [(i, f"http://h{i % 2}.example/a", page(i, BODY.format(i, i))) for i in range(12)]
    assert {r["page_id"]: r["text"] for r in html.extract(pages(rows)).collect()} == {i: text(i) for i in range(12)}
