import html
import random
import re

from rillet.llm import html_template as page
from rillet.llm.queries import QUERIES
from rillet.sources.tables import table

from .conftest import SF, prose


def article_of(source):
    """Main text of the given pages: what stands in their article element."""
    inner = re.search(r"<article>(.*?)(</article>|\Z)", source or "", re.S)
    text = inner[1] if inner else ""
    text = re.sub(r"<(br|/?p|/?h1)>", " ", text)
    return " ".join(html.unescape(re.sub(r"<[^>]*(>|\Z)", "", text)).split())


def test_query_on_the_given_pages(spark):
    want = {r.page_id: (r.url, article_of(r.html)) for r in table(spark, SF, "pages").collect()}
    rows = QUERIES["op4_template_extraction"](spark, SF).collect()
    assert {r.page_id: (r.url, r.text) for r in rows} == want and len(rows) == len(want)
    assert all(r.n_chars == len(r.text) for r in rows)


def site(rng, k, paragraphs, tagged=True):
    """(page, main text): a page with everything that is not main text around it."""
    texts = [f"{prose(rng, rng.randrange(20, 60))} café {k}-{j}." for j in range(paragraphs)]
    marked = [t.replace("w1", "<b>w1</b>").replace("café", "caf&eacute;") for t in texts]
    body = f"<h1>Title\n  of {k}</h1>" + "".join(f"<p>{t}" + "</p>" * (j % 2) for j, t in enumerate(marked))
    body += "<script>var x = '<p>no</p>';</script><div class='advert-box'><p>buy now</p></div>"
    body += "<section id=comments><article><p>reader says hello</p></article></section>"
    around = "article" if tagged else "div"
    links = "".join(f"<li><a href=/{rng.random()}>{prose(rng, 3)}</a>" for _ in range(rng.randrange(2, 9)))
    full = (f"<!DOCTYPE html><html><head><title>t {k}</title><style>p{{}}</style></head><body>"
            f"<header><p>The Site</p></header><ul class=menu>{links}</ul>"
            f"<div class='cols'><div class='left'><ul>{links}</ul></div>"
            f"<{around} class=text>{body}</{around}><aside><p>elsewhere {k}</p></aside></div>"
            f"<div class='bottom'><p>Every page says this</p></div><form><p>your mail</p></form>"
            f"<!-- {k} --><footer>&copy; {k}</footer></body></html>")
    return full, " ".join([f"Title of {k}", *texts])


def test_templates_with_and_without_an_article_element():
    rng = random.Random(5)
    for tagged in (True, False):
        pages = [site(rng, k, rng.randrange(1, 7), tagged) for k in range(12)]
        for some in (pages, pages[:4]):
            assert page.extract([p for p, _ in some]) == [t for _, t in some]
        # one page shows no template: what stands around its text stays, without an article
        rest = "" if tagged else " Every page says this"
        assert page.extract([pages[0][0]]) == [pages[0][1] + rest]


def test_classes_nest():
    pages = [page.parse("<body><div class=a><ul>" + "<li><p>x</p></li>" * n + "</ul></div><p>y</p></body>")
             for n in (2, 3, 5)]
    root, nested = page.classes(pages)
    assert root[0] == "/body" and root[-1] == "//body" and "/body/div.a/ul" in root
    assert nested == {root.index("/body/div.a/ul") + 1: [
        ["/body/div.a/ul/li", "/body/div.a/ul/li/p", "//body/div.a/ul/li/p", "//body/div.a/ul/li"]]}


def test_title_and_lead_beside_a_body_div_stay():
    rng = random.Random(21)
    for around in ("article", "main", "div"):
        for lead_tag in ("p", "div"):
            sources, want = [], []
            for k in range(12):
                lead, body = f"lead {k} {prose(rng, 12)}", [prose(rng, 90), prose(rng, 90)]
                sources.append(
                    f"<html><body><header>The Site</header><div class=menu><a href=/>home</a></div>"
                    f"<{around} class=entry><h1>Title {k}</h1><{lead_tag} class=lead>{lead}</{lead_tag}>"
                    f"<div class=body>" + "".join(f"<p>{x}</p>" for x in body) + "</div>"
                    f"</{around}><div class=foot><p>Always here</p></div></body></html>")
                want.append(" ".join([f"Title {k}", lead, *body]))
            for n in (1, 2, 4, 12):
                # few pages without an article show no template, so nothing goes for it
                rest = " Always here" if around == "div" and n < page.LEAST_PAGES else ""
                assert page.extract(sources[:n]) == [w + rest for w in want[:n]], (around, lead_tag, n)


def test_text_around_the_main_element_stays():
    rng = random.Random(22)
    flat = [f"<body><h1><a href=/{k}>Title {k}</a></h1><div class=lead>lead {k}</div><div class=body><p>"
            f"{prose(rng, 90)}</p></div><p>end {k}</p><div class=all>Always</div></body>" for k in range(8)]
    for n in (1, 3, 8):
        for k, text in enumerate(page.extract(flat[:n])):
            rest = "" if n >= page.LEAST_PAGES else " Always"
            assert text.startswith(f"Title {k} lead {k} ") and text.endswith(f" end {k}{rest}")
    # a minority layout with a small block in the majority's element
    other = (f"<body><h1>Other</h1><div class=body><p>note</p></div><div class=wide><p>"
             f"{prose(rng, 90)} last</p></div><div class=all>Always</div></body>")
    for n in (2, 8):
        text = page.extract([*flat[:n], other])[-1]
        assert text.startswith("Other note ") and " last" in text


def test_words_of_classes_mark_no_main_text():
    rng = random.Random(23)
    text = prose(rng, 80)
    for source in (
            "<body class='page has-sidebar'><p>{}</p></body>", "<body class=no-sidebar><div><p>{}</p></div></body>",
            "<html class=header-fixed><body><p>{}</p></body></html>", "<body id=search><p>{}</p></body>",
            "<body><article class='post comments-open'><p>{}</p></article></body>",
            "<body><main role=main class=widget><p>{}</p></main></body>",
            "<body><div class='content with-related'><p>{}</p></div></body>",
            "<body><div class='widget'><p>{}</p></div><div class=hasSidebar></div></body>",
            "<article><div class='share-wrapper'><div class=promo><p>{}</p></div></div></article>"):
        for noise in ("<div class=sidebar>no</div>", "<div class='sidebar-left'>no</div>", "<div id=mainNav>no</div>",
                      "<div class='site-footer-wrap'>no</div>", "<div class='x ad'>no</div>"):
            page_of = source.format(text + "</p>" + noise + "<p>")
            for some in ([page_of], [page_of] * 3):
                assert page.extract(some) == [text] * len(some), (source, noise)
    for long in ("comments", "comment-list replies"):  # readers may write more than the author
        assert page.extract([f"<body><div class=post><p>{text}</p></div><div class='{long}'><p>"
                             f"{prose(rng, 300)}</p></div></body>"]) == [text]


def test_svg_and_math_amid_an_article():
    for amid, text in (
            ("<svg class=icon />", ""), ("<svg/>", ""), ("<svg viewBox='0 0 1 1'><text>no</text></svg>", ""),
            ("<math/>", ""), ("<math display=block />", ""),
            ("<math><mrow><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac></mrow></math>", "x = 1 2 ")):
        source = f"<article><p>before {amid} after</p><p>next</p></article><footer>no</footer>"
        assert page.extract([source]) == [f"before {text}after next"], amid


def test_broken_markup():
    cases = {None: "", "": "", "plain words": "plain words", "<p>a<p>b": "a b", "<div>a<b>b</b>c</div>": "abc",
             "a&nbsp;&amp; b&lt;c": "a & b<c", "x<br>y": "x y", "<p>end <a href='un": "end",
             "</div></p>stray": "stray", "<script>never closed": "", "<!-- open": "", "1 < 2 > 0": "1 < 2 > 0",
             "<p hidden>no</p><p>yes</p>": "yes", "<div style='display: none'>no</div>yes": "yes",
             "<ul><li>a<li>b</ul>": "a b", "<article><header><h1>T</h1></header><p>x</article>": "T x"}
    for source, want in cases.items():
        assert page.extract([source]) == [want], source
    assert page.extract(["<p>" * 20_000 + "deep" + "<div>" * 3000])[0] == "deep"


def test_odd_rows_and_a_hot_host(spark):
    rng = random.Random(7)
    pages = [site(rng, k, 3) for k in range(150)]
    rows = [(k, f"https://www.hot.example/{k}", p, "x") for k, (p, _) in enumerate(pages)]
    odd = [(900, None, "<p>no url</p>", None), (901, "https://a.example/", None, None),
           (902, "not a url", "", None), (None, "https://b.example", "<p>no id</p>", None), rows[3]]
    frame = spark.createDataFrame(rows + odd, "page_id bigint, url string, html string, text string")
    got = page.main_text(frame, group=20).collect()
    want = [(k, t) for k, (_, t) in enumerate(pages)] + [
        (900, "no url"), (901, ""), (902, ""), (None, "no id"), (3, pages[3][1])]
    assert sorted(map(str, [(r.page_id, r.text) for r in got])) == sorted(map(str, want))
    assert page.main_text(frame.limit(0)).count() == 0


def layouts(rng, n):
    """(name, pages, main texts): what only the pages of a host together can tell."""
    text = [f"{prose(rng, rng.randrange(60, 90))} end {k}." for k in range(n)]
    teaser = lambda: f"<article><p>{prose(rng, 12)}</p></article>"
    own = lambda k: f"<h1>Title {k}</h1><p>{text[k]}</p>"
    want = [f"Title {k} {t}" for k, t in enumerate(text)]
    yield "a notice in the article", [
        f"<body><article>{own(k)}<p>This site will be closed for works next week</p></article></body>"
        for k in range(n)], want
    for around in ("article", "div"):
        yield f"a notice with a number, {around}", [
            f"<body><{around} class=text>{own(k)}<p class=v>Visitor number {rng.randrange(10**6)} welcome here</p>"
            f"<div class=d>Printed on day {k} of the year</div></{around}></body>" for k in range(n)], want
    yield "teasers of another section", [
        f"<body><div class=one><article>{own(k)}</article></div><section class=more>"
        + "".join(teaser() for _ in range(2 + k % 4)) + "</section></body>" for k in range(n)], want
    yield "teasers in main", [
        f"<main><article>{own(k)}</article><section><h2>Read more of us</h2>{teaser()}{teaser()}</section></main>"
        for k in range(n)], want
    yield "readers' posts in the article", [
        f"<body><article>{own(k)}<div class=x>" + "".join(teaser() for _ in range(k % 4)) + "</div></article></body>"
        for k in range(n)], want
    yield "share links in a class of another name", [
        f"<body><article>{own(k)}<div class=social-kiosk><a href=a{k}>Tell it to {prose(rng, 2)}</a></div></article></body>"
        for k in range(n)], want


def test_the_template_decides(monkeypatch):
    """Without deduction every one of these layouts gives another text."""
    for name, sources, want in layouts(random.Random(31), 12):
        assert page.extract(sources) == want, name
        with monkeypatch.context() as m:
            m.setattr(page, "_template", lambda ps: [[False] * len(p.blocks) for p in ps])
            m.setattr(page, "_own_articles", lambda ps: [[b for b in bs if b.article] for bs in ps])
            m.setattr(page, "_confirmed", lambda ps, t: set())
            assert page.extract(sources) != want, name


def test_template_blocks_against_a_plain_search():
    """Small made blocks: the rule word by word, page by page."""
    rng = random.Random(33)
    for _ in range(300):
        pages = []
        for _ in range(rng.randrange(3, 7)):
            body = "".join(f"<{tag}>{' '.join(rng.choice('abcd') for _ in range(rng.randrange(1, 6)))}</{tag}>"
                           for tag in rng.choices(["p", "div", "h1"], k=rng.randrange(1, 4)))
            shared = "".join(f"<p>v w {rng.choice('xyz')} u</p>" for _ in range(rng.random() < 0.9))
            pages.append(page.parse(f"<body>{body}{shared}</body>"))

        def count(p, path, word):
            return sum(b.text.split().count(word) for b in p.blocks if b.path == path)

        def words(b):
            return [w for w in b.text.split() if len({count(p, b.path, w) for p in pages}) == 1]

        def is_template(b):
            if len(pages) < page.LEAST_PAGES or b.path.endswith("/h1"):
                return False
            if all(any(o.path == b.path and o.text == b.text for o in p.blocks) for p in pages):
                return True
            ws = words(b)
            return len(ws) >= 3 and 2 * len(ws) >= len(b.text.split()) and all(
                any(o.path == b.path and words(o) == ws and 2 * len(ws) >= len(o.text.split()) for o in p.blocks)
                for p in pages)
        assert page._template(pages) == [[is_template(b) for b in p.blocks] for p in pages]


def test_nothing_else_is_dropped():
    rng = random.Random(35)
    text = prose(rng, 80)
    # classes that only begin or end with a word of boilerplate, in groups of any size
    for name in ("class='social-history'", "class='search-engines'", "id='notice-of-meeting'", "class=earlyAds"):
        sources = [f"<article><h1>T</h1><div {name}><p>{text} {k}</p></div><p>{prose(rng, 70)} {k}</p></article>"
                   for k in range(12)]
        for n in (1, 3, 12):
            assert all(f"{text} {k}" in t for k, t in enumerate(page.extract(sources[:n]))), (name, n)
    # a small second block beside the main one, on a page alone and on few pages
    for n in (1, 3):
        sources = [f"<body><div class=main-a><p>{text}</p></div><div class=b><p>{prose(rng, 15)}</p></div></body>"] * n
        assert all(len(t.split()) == 95 for t in page.extract(sources))
    # copies of one article on a host, whole and with a few words of their own
    copies = [f"<body><article><h1>T</h1><p>{text}</p><p>{text} more</p><p>{k}</p></article></body>" for k in range(8)]
    assert page.extract(copies) == [f"T {text} {text} more {k}" for k in range(8)]
    assert page.extract([copies[0]] * 8) == [f"T {text} {text} more 0"] * 8
    same = [f"<body><div><p>{text}</p></div></body>"] * 6
    assert page.extract(same) == [text] * 6
    # two parts of an article at different places
    parts = [f"<body><div class=a><article><p>{text} {k}</p></article></div><div class=b><article><p>"
             f"{prose(rng, 40)} {k}</p></article></div></body>" for k in range(8)]
    assert all(t.count(f" {k}") >= 2 for k, t in enumerate(page.extract(parts)))
