import hashlib
import math
import os
import random
import re
import textwrap
from collections import Counter, defaultdict
from html.parser import HTMLParser

import pytest

from weftmatch.llm import licence_texts, op02_html, op04_warc, op08_urls, op09_licences

PAGE = "<html><head><title>t</title><style>p{}</style></head><body><nav><li>menu</nav><header>top</header><article><h1>Head</h1><p>One &amp;\n two<br>three<p>Four<div class='comments'><p>reader</div><article>nested</article></article><aside>side</aside><footer>&copy;</footer>"


@pytest.mark.parametrize(
    ("html", "want"),
    [
        (PAGE, "Head\nOne & two three\nFour"),
        ("<body><nav>m</nav><div class='post'>a<p>b &amp; c&nbsp;d<ul><li>x<li>y</ul></div><form>f</form>", "a\nb & c d\nx\ny"),
        ("<main><header><h1>T</h1></header><section id=comments>q</section><p>ok</main>", "T\nok"),
        ("<p>a<script>x</script>b<p hidden>c</p>d", "ab\nd"),
        ("plain", "plain"),
        ("", ""),
        ("<article></article>", ""),
        ("<article><table><tr><td>1<td>2</table>", "1\n2"),
        ("<article>a < b <!-- c --> d", "a < b d"),
        ("<article>a</article><!-- b <p>c", "a"),
        ("<p>a<!-- b", "a"),
        ("a" + "<!--" * 50_000, "a"),
        ('<a "' * 30_000, '<a "' * 30_000),
        ("<b>" * 20_000 + "x" + "</i>" * 20_000, "x"),
        ("<article><h2 id='related-work'>Related</h2><div class='share-price'>9</div><p><math><mi>x</mi></math></p><div class='share-buttons'>Share</div></article>", "Related\n9\nx"),
    ],
)
def test_main_text(html, want):
    assert op02_html.main_text(html) == (want, 0)


def test_templates(spark):
    pages = [(i, f"https://S.example/{i}", f"<article><div><p>Subscribe today</p></div><p>story {i}</p></article>") for i in range(20)]
    pages += [(100 + i, f"https://other.example/{i}", f"<article><p>Subscribe today</p><p>tale {i}</p></article>") for i in range(3)]
    pages += [(200, None, None), (200, "no host", "<p>x"), (None, "https://s.example/", "")]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, text string")
    got = Counter((r["page_id"], r["text"]) for r in op02_html.extract(df).collect())
    want = Counter({(i, f"story {i}"): 1 for i in range(20)} | {(100 + i, f"Subscribe today\ntale {i}"): 1 for i in range(3)} | {(200, ""): 1, (200, "x"): 1, (None, ""): 1})
    assert got == want
    assert op02_html.extract(df.limit(0)).count() == 0


def test_copies_are_no_template(spark):
    """A host of which most rows are copies of one article: its text stays, what distinct pages share still goes."""
    page = "<article><div><p>Subscribe today</p></div><h1>{0}</h1><p>Text of {0}</p><ul><li>point {0}</ul></article>"
    copies = [(i, f"https://s.example/{i}", page.format("copy")) for i in range(30)] + [(100 + i, None, page.format("lost")) for i in range(12)]
    others = [(200 + i, f"https://s.example/o{i}", page.format(i)) for i in range(12)]
    df = spark.createDataFrame(copies + others, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in op02_html.extract(df).collect()}
    text = lambda x: f"{x}\nText of {x}\npoint {x}"
    assert got == {i: text("copy") for i in range(30)} | {100 + i: f"Subscribe today\n{text('lost')}" for i in range(12)} | {200 + i: text(i) for i in range(12)}


def nameless(i, story, menu="", note="Alpha line one of the house"):
    """A page whose chrome has no tell-tale element or name."""
    links = "".join(f"<li><a href='/{k}'>go {k}{menu}</a></li>" for k in range(1 + i % 4))
    return f"<body><div class='k1'><ul>{links}</ul></div><div class='k2'>{story}</div><div class='k3'>{note}</div></body>"


@pytest.mark.parametrize("limits", [{}, {"BROADCAST_HASHES": 0}])
def test_templates_without_names(spark, monkeypatch, limits):
    """Equal notices go by their text, menus by their shape and place; with lists by host and with lists by page."""
    for k, v in limits.items():
        monkeypatch.setattr(op02_html, k, v)
    pages = [(i, "https://s.example/", nameless(i, f"<p>Story number {i} of the day</p><p>Second part {i}</p>", menu=f" w{i}")) for i in range(24)]
    pages += [(100 + i, "https://small.example/", nameless(i, f"<p>Tale {i}</p>", menu=f" v{i}")) for i in range(2)]
    framed = "<body><div class='q'>Buy {0} and {1}</div><article><p>Real {0}</p></article><section>More of {1}</section></body>"
    pages += [(200 + i, "https://f.example/", framed.format(i, 7 * i + 1)) for i in range(4)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: (r["text"], r["n_template"]) for r in op02_html.extract(df).collect()}
    menu = lambda i, w: "".join(f"go {k} {w}{i}\n" for k in range(1 + i % 4))
    want = {i: (f"Story number {i} of the day\nSecond part {i}", 2) for i in range(24)}
    want |= {100 + i: (f"{menu(i, 'v')}Tale {i}\nAlpha line one of the house", 0) for i in range(2)}
    want |= {200 + i: (f"Real {i}", 2) for i in range(4)}
    assert got == want


def test_near_copies_are_no_template(spark):
    """Near copies of one article on a host share most blocks: all of their text stays."""
    parts = [f"<p>Paragraph {k} of the copied piece</p>" for k in range(8)]
    pages = [(i, "https://s.example/", "<article>" + "".join(parts[:i % 8] + [f"<p>Own line {i}</p>"] + parts[i % 8 + 1 :]) + "</article>") for i in range(30)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    for r in op02_html.extract(df).collect():
        assert r["text"] == "\n".join(f"Own line {r['page_id']}" if k == r["page_id"] % 8 else f"Paragraph {k} of the copied piece" for k in range(8))


class Article(HTMLParser):
    """The blocks of article elements, by the standard library's tokeniser."""

    def __init__(self):
        super().__init__()
        self.depth, self.raw, self.blocks, self.line = 0, False, [], ""

    def cut(self):
        self.blocks, self.line = self.blocks + [t for t in [" ".join(self.line.split())] if t], ""

    def handle_starttag(self, tag, attrs):
        self.depth += tag == "article"
        self.raw = tag in ("script", "style")
        if tag in ("p", "h1", "li", "ul", "article"):
            self.cut()
        elif tag == "br":
            self.line += " "

    def handle_endtag(self, tag):
        self.raw = False
        if tag in ("p", "h1", "li", "ul", "article"):
            self.cut()
        self.depth -= tag == "article"

    def handle_data(self, data):
        if self.depth and not self.raw:
            self.line += data


def brute_templates(pages):
    """Subtrees outside the article that a host's pages have at the same place: the body's children beside it, by name and class."""
    seen = defaultdict(set)
    for url, html in pages:
        for x in {m for m in re.findall(r"<(nav|div class=\"ad\"|footer)>", html)}:
            seen[op_host(url), x].add(html)
    n = Counter(op_host(u) for u, _ in set(pages))
    return {k for k, v in seen.items() if len(v) >= 10 or len(v) >= 3 and 2 * len(v) >= n[k[0]]}


def op_host(url):
    return re.match(r"[^:]*://([^/?#]*)", url)[1].lower()


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_query_against_brute_force(spark):
    """The registered query over whole pages: text, length and deleted templates."""
    from weftmatch.llm.queries import op2_html_templates

    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    templates = brute_templates([(r["url"], r["html"]) for r in rows])
    want = {}
    for r in rows:
        a = Article()
        a.feed(r["html"])
        text = "\n".join(a.blocks)
        want[r["page_id"]] = (r["url"], text, len(text), sum((op_host(r["url"]), x) in templates for x in ("nav", 'div class="ad"', "footer")))
    got = {r["page_id"]: (r["url"], r["text"], r["n_chars"], r["n_template"]) for r in op2_html_templates(spark, "/root/testdata/sf0.01").collect()}
    assert got == want and sum(x[3] > 0 for x in want.values()) > len(want) / 2


def test_archive(spark, tmp_path):
    big, small = "x" * 1500, "s" * 20
    rows = [(1, "u1", big), (2, "u2", big), (5, "u\r\nX: 1", big), (3, None, small), (4, "u4", small), (6, "u6", None), (7, "é", "é" * 500), (8, "é", "é" * 500), (None, "n", big)]
    df = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, digest string")
    folder = f"file://{tmp_path}/a"
    op04_warc.write_archive(df, folder)
    got = {r["page_id"]: r for r in op04_warc.read_archive(spark, folder).collect()}
    assert len(got) == len(rows)
    for i, _, h in rows:
        assert bytes(got[i]["payload"]) == (h or "").encode() and got[i]["payload_digest"] == hashlib.sha1((h or "").encode()).hexdigest()
    assert {i: r["refers_to"] for i, r in got.items() if r["record_type"] == "revisit"} == {1: 5, 2: 5, 7: 8, None: 5}
    assert spark.read.parquet(f"{folder}/payloads").count() == 4
    records = {r["page_id"]: bytes(r["record"]) for r in op04_warc.original_records(spark, folder).collect()}
    assert records[5].startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and records[5].endswith(b"\r\n\r\n" + big.encode() + b"\r\n\r\n") and b"\r\nX: 1" not in records[5]
    assert b"Content-Length: 0\r\n" in records[1]
    op04_warc.write_archive(df.limit(0), f"{folder}0")
    assert op04_warc.read_archive(spark, f"{folder}0").count() == 0


def test_archive_of_text_ids(spark, tmp_path):
    """Page ids that are no numbers: references keep them as they are."""
    big = "y" * 1200
    ids = ["a<1>", "b\r\nX: 2", "", "é", None]
    df = spark.createDataFrame([(i, "u", big) for i in ids] + [("other", "ü", "é" * 700)], "page_id string, url string, html string")
    folder = f"file://{tmp_path}/a"
    op04_warc.write_archive(df, folder)
    got = {r["page_id"]: r for r in op04_warc.read_archive(spark, folder).collect()}
    assert {i: (r["record_type"], r["refers_to"]) for i, r in got.items()} == {i: ("response", None) if i in ("é", "other") else ("revisit", "é") for i in [*ids, "other"]}
    assert {bytes(r["payload"]) for r in got.values()} == {big.encode(), ("é" * 700).encode()}
    assert got["other"]["header"].startswith("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:other>\r\nWARC-Target-URI: ü\r\n")


def test_digests_are_verified_at_the_write(spark, tmp_path, monkeypatch):
    """Two payloads under one strong digest stop the job."""
    real = op04_warc.F.sha2
    monkeypatch.setattr(op04_warc.F, "sha2", lambda c, bits: real(op04_warc.F.lit(b"same"), 256) if bits == 256 else real(c, bits))
    df = spark.createDataFrame([(1, "u", "one"), (2, "u", "two")], "page_id long, url string, html string")
    with pytest.raises(Exception, match="different payloads have the digest"):
        op04_warc.write_archive(df, f"file://{tmp_path}/c")


def test_damaged_archive(spark, tmp_path):
    folder = f"file://{tmp_path}/a"
    op04_warc.write_archive(spark.createDataFrame([(1, "u", "x")], "page_id long, url string, html string"), folder)
    spark.read.parquet(f"{folder}/payloads").selectExpr("digest", "cast('y' as binary) as payload", "last_id", "sha1", "size").write.parquet(f"file://{tmp_path}/b/payloads")
    spark.read.parquet(f"{folder}/records").write.parquet(f"file://{tmp_path}/b/records")
    with pytest.raises(Exception, match="differs from its digest"):
        op04_warc.read_archive(spark, f"file://{tmp_path}/b").collect()


@pytest.mark.parametrize(
    ("url", "host", "path", "rule"),
    [
        ("https://A.Example.com/en/1?q", "a.example.com", "/en/1", "example.com/en/"),
        ("http://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/"),
        ("http://x.www.example.com/en/#a", "x.www.example.com", "/en/", "www.example.com/en/"),
        ("http://example.com/fr/", "example.com", "/fr/", "com/"),
        ("http://notexample.net/es/1", "notexample.net", "/es/1", "net/es/"),
        ("http://example.com", "example.com", "", None),
        ("http://a.org?x=http://b.com/", "a.org", "", None),
        ("no scheme", "", "", None),
        (None, "", "", None),
        ("", "", "", None),
    ],
)
def test_rules(spark, url, host, path, rule):
    df = spark.createDataFrame([(1, url, "x")], "page_id long, url string, host string")
    none = spark.createDataFrame([], "url string, label int")
    r = op08_urls.judge(df, none).first()
    assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
    assert r["verdict"] == {"example.com/en/": "block", "net/es/": "block"}.get(rule, "allow")


def test_url_model(spark):
    """Hosts that are not in the training table: known words in new compounds, and harmless words and names kept out of it."""
    words = op08_urls.labelled_words()
    r = random.Random(5)
    held = set(r.sample([w for w, y in words if not y], 100))
    ends = "zone site hub king world land center point".split()
    rows = [(f"https://{w}{x}.example.org/p/1", y) for w, y in words if w not in held for x in r.sample(ends, 2)] + [(f"https://www.{w}.example.org/x/{k}", 0) for k, w in enumerate(sorted(held))]
    df = spark.createDataFrame([(k, *x) for k, x in enumerate(rows)], "page_id long, url string, y int")
    model = [x for x in words if x[0] not in held]
    got = {x["page_id"]: x["verdict"] for x in op08_urls.judge(df, op08_urls.labelled_urls(spark, model), rules=()).collect()}
    bad, good = [got[k] for k, x in enumerate(rows) if x[1]], [got[k] for k, x in enumerate(rows) if not x[1]]
    assert good.count("allow") / len(good) > 0.98 and bad.count("block") / len(bad) > 0.8
    known = spark.createDataFrame([(1, "https://www.casino.example.org/q"), (2, "https://pills-shop.shop.org/"), (3, "https://garden-journal.museum.org/x")], "page_id long, url string")
    assert {x["page_id"]: x["verdict"] for x in op08_urls.judge(known, op08_urls.labelled_urls(spark)).collect()} == {1: "block", 2: "block", 3: "allow"}
    with pytest.raises(ValueError):
        op08_urls.rule_columns((op08_urls.RULES[0],) * 2000, None, None)


def brute_url(url):
    """Host, path and rule by hand."""
    head, mark, rest = (url or "").partition("://")
    h, p = "", ""
    if mark:
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        h, p = rest[:cut].translate({c: c + 32 for c in range(65, 91)}), re.split(r"[?#]", rest[cut:], maxsplit=1)[0]
    fits = [x for x in op08_urls.RULES if (h == x.host or h.endswith("." + x.host)) and p.startswith(x.path)]
    best = max(fits, key=lambda x: len(x.name), default=None)
    return h, p, best and best.name, best and best.verdict


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_url_query_against_brute_force(spark):
    """The registered query: rules by hand; the model's scores from its weights, gram by gram."""
    from pyspark.ml.feature import HashingTF
    from weftmatch.llm.queries import op8_url_filter

    model = op08_urls.train(op08_urls.labelled_urls(spark))
    index = HashingTF(numFeatures=op08_urls.FEATURES, inputCol="g", outputCol="f")
    weights, base = model.coefficients.toArray(), model.intercept
    place = {}

    def score(h, p):
        grams = {f"{k}:{t[i : i + n]}" for k, t in (("h", re.sub("[0-9]", "0", f"^{h}$")), ("p", re.sub("[0-9]", "0", f"^{p}$"))) for n in op08_urls.GRAMS for i in range(len(t) - n + 1)}
        for g in grams - set(place):
            place[g] = index.indexOf(g)
        return 1 / (1 + math.exp(-base - sum(weights[i] for i in {place[g] for g in grams})))

    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url").collect()
    got = {r["page_id"]: r for r in op8_url_filter(spark, "/root/testdata/sf0.01").collect()}
    assert len(got) == len(rows)
    for r in rows:
        h, p, rule, verdict = brute_url(r["url"])
        x = got[r["page_id"]]
        s = score(h, p)
        assert (x["host"], x["path"], x["rule"]) == (h, p, rule) and x["score"] == pytest.approx(s, abs=2e-6)
        assert x["verdict"] == (verdict or ("block" if s >= 0.5 else "allow"))


def brute_licences(files, templates=op09_licences.TEMPLATES, threshold=op09_licences.THRESHOLD):
    """Own licence of every file, all units against all templates."""
    split = lambda t: [w for w in re.split(r"[\W_]+", t.lower()) if w]
    n, df = len(files), Counter()
    for _, _, t in files:
        df.update(set(split(t or "")))
    vocabulary = {w for x in templates for w in split(x.text)}
    idf = lambda w: math.log((1 + n) / (1 + (df[w] if w in vocabulary else 0))) + 1
    vec = lambda t: {w: (1 + math.log(c)) * idf(w) for w, c in Counter(split(t)).items()}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    known = [(x, vec(x.text), set(x.must)) for x in templates]
    best = {}
    for i, p, t in files:
        lines = (t or "").split("\n")
        paragraphs = [[]]
        for line in lines:
            if split(line):
                paragraphs[-1].append(line)
            elif paragraphs[-1]:
                paragraphs.append([])
        units = [(0, 0, t or ""), (1, 0, "\n".join(lines[:30])), *((2, k, "\n".join(x)) for k, x in enumerate(paragraphs)), *((3, k, x) for k, x in enumerate(lines))]
        for kind, no, said in units:
            v = vec(said)
            for x, u, must in known:
                s = round(sum(y * u.get(w, 0) for w, y in v.items()) / (norm(v) * norm(u)), 9) if v else 0
                if s >= threshold and must <= set(v):
                    key = (x.license == "Proprietary", -s, kind, no, x.license)
                    best[i, p] = min(best.get((i, p), key), key)
    return {(i, p): (best[i, p][4], op09_licences.UNITS[best[i, p][2]], -best[i, p][1]) if (i, p) in best else None for i, p, _ in files}


def brute_inherited(files, own):
    """Licence of every file by walking up its directories."""
    sources = {}
    for i, p, _ in sorted(files, key=lambda f: str(f[0])):
        d, _, name = p.rpartition("/")
        if re.match(r"(?i)(licen[cs]e|copying|notice)([._-].*)?$", name) and own[i, p]:
            key = (-own[i, p][2], i, p)
            sources[d] = min(sources.get(d, (key, own[i, p][0])), (key, own[i, p][0]))
    out = {}
    for i, p, _ in files:
        d = p.rpartition("/")[0]
        while not own[i, p] and d and d not in sources:
            d = d.rpartition("/")[0]
        out[i, p] = (own[i, p][0], None) if own[i, p] else (sources[d][1], d) if d in sources else (None, None)
    return out


L = {(x.license, len(x.text) > 120): x.text for x in reversed(op09_licences.TEMPLATES)}
MIT_FILE = "MIT License\n\nCopyright (c) 2019 Some Body\n\n" + "\n\n".join(textwrap.fill(x, 70) for x in (licence_texts._MIT_GRANT, licence_texts._MIT_NOTICE, licence_texts._AS_IS))
APACHE_FILE = "                                 Apache License\n                           Version 2.0, January 2004\n                        http://www.apache.org/licenses/\n\n   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION\n\n   1. Definitions.\n"
HEADER = "/*\n * Copyright 2020 The Writers\n *\n" + "\n".join(" * " + x for x in textwrap.wrap(licence_texts._gnu("GNU General Public License", "2"), 60)) + "\n */\nint main() { return 0; }\n"


def test_licences(spark):
    files = [
        (1, "r/LICENSE", f"words\n{L['MIT', False]}"), (2, "r/a/x.py", "plain text"), (3, "r/a/b/y.py", f"# {L['Apache-2.0', False]}\ncode"), (4, "r/a/COPYING.txt", "This work is licensed under the GNU General Public License, version 3."), (5, "r/a/b/z.py", None),
        (6, "q/x.py", "the public of license"), (7, None, ""), (8, "r/c/d/e/f.py", "no header"), (9, "r/a/b/y.py", "license the work under the general public"), (10, "LICENSES/x", "x"),
        (11, "m/LICENSE", MIT_FILE), (12, "m/s/t.py", "text"), (13, "p/LICENSE.txt", APACHE_FILE), (14, "p/a/b/c/d.py", "x y"), (15, "h/x.c", HEADER), (16, "g/COPYING", "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Everyone is permitted to copy"),
        (17, "z/a", "All rights reserved."), (18, "z/b", "MIT License"), (19, "z/c", "Apache License"), (20, "z/d", "Released under the Bar License."), (21, "z/e", "Copyright (c) All rights reserved.\n\n" + licence_texts._BSD_GRANT + "\n" + licence_texts._BSD_TERMS + "\n" + licence_texts._BSD_AS_IS),
    ]
    df = spark.createDataFrame([(*f, "x") for f in files], "file_id long, path string, text string, license string")
    rows = {(r["file_id"], r["path"]): r for r in op09_licences.scan(df).collect()}
    paths = [(i, p or "", x) for i, p, x in files]
    own = brute_licences(paths)
    assert {k: r["own_license"] and (r["own_license"], r["own_unit"], pytest.approx(r["own_score"], abs=2e-9)) for k, r in rows.items()} == own
    assert {k: (r["license"], r["inherited_from"]) for k, r in rows.items()} == brute_inherited(paths, own)
    got = {i: r["license"] for (i, _), r in rows.items()}
    assert got == {1: "MIT", 2: "GPL-3.0", 3: "Apache-2.0", 4: "GPL-3.0", 5: "GPL-3.0", 6: None, 7: None, 8: "MIT", 9: got[9], 10: None, 11: "MIT", 12: "MIT", 13: "Apache-2.0", 14: "Apache-2.0", 15: "GPL-2.0", 16: "GPL-3.0", 17: "Proprietary", 18: "MIT", 19: "Apache-2.0", 20: None, 21: "BSD-2-Clause"}
    assert op09_licences.scan(df.limit(0)).count() == 0


def test_licences_of_repeated_rows(spark):
    """Equal ids and paths are one file, each text scored by itself; ids may be text; null ids are files too."""
    files = [("a", "r/x.py", "Released under the MIT License."), ("a", "r/x.py", "Dedicated words of a page\nmore"), ("b", "r/x.py", "Released under the MIT License."), (None, "r/LICENSE", "Licensed under the Apache License, Version 2.0."), ("c", "r/y", "x")]
    df = spark.createDataFrame(files, "file_id string, path string, text string")
    got = Counter((r["file_id"], r["own_license"], r["license"]) for r in op09_licences.scan(df).collect())
    assert got == Counter({("a", "MIT", "MIT"): 2, ("b", "MIT", "MIT"): 1, (None, "Apache-2.0", "Apache-2.0"): 1, ("c", None, "Apache-2.0"): 1})
    docs = spark.createDataFrame([("k1", "s", "x"), (None, None, None)], "doc_id string, source string, text string")
    assert op09_licences.scan(op09_licences.files_of(docs)).count() == 2


def test_random_trees_of_licences(spark):
    """Inheritance against walking up, over random trees and texts."""
    r = random.Random(8)
    said = [x.text for x in op09_licences.TEMPLATES if len(x.text) < 120]
    folder = lambda: "/".join(r.choice("abc") for _ in range(r.randint(0, 4)))
    files = []
    for i in range(150):
        d, name = folder(), r.choice(["LICENSE", "NOTICE.md", "x.py", "y.txt", "licenses"])
        files.append((i, f"{d}/{name}" if d else name, r.choice([f"some words\n{r.choice(said)}\nend", "plain", None, ""])))
    df = spark.createDataFrame(files, "file_id long, path string, text string")
    own = brute_licences(files)
    got = {(x["file_id"], x["path"]): (x["license"], x["inherited_from"]) for x in op09_licences.scan(df).collect()}
    assert got == brute_inherited(files, own)


def test_key_pattern():
    words = ["a", "an", "and", "android", "b", "gnu", "general"]
    pattern = re.compile(op09_licences.key_pattern(words).replace("(?iu)", "(?i)").replace(r"\p{L}\p{N}", "a-z0-9"))
    for w in [*words, "ande", "andr", "x", "gn", "gnus", "generals", "AND"]:
        assert bool(pattern.search(f"see {w}, then")) == (w.lower() in words), w
