import json
import random
import re
import time

from telemere.llm import wrappers
from tests.llm.data import plain

SCHEMA = "page_id long, url string, html string, host string, wrapper string, pages int"


def page(paragraphs, title="A title", items=3, extra="", tail="</body></html>"):
    menu = "".join(f"<li><a href='/{i}'>item {i} {title}</a></li>" for i in range(items))
    body = "".join(f"<p>{p}" for p in paragraphs)
    return (
        f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style><script>var t='</p>';</script></head>"
        f"<body><header>Site</header><nav><ul>{menu}</ul></nav>{extra}<!-- x --><article><h1>{title}</h1>{body}</article>"
        f"<div class='comments'><p>reader says {title}</p></div><footer>&copy; us {title}</footer>{tail}"
    )


def table(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y", 1) for i, u, h in rows], SCHEMA)


def run(spark, rows):
    return {r.page_id: r for r in wrappers.extract(table(spark, rows)).collect()}


def test_article_without_furniture(spark):
    rows = [(i, f"http://A.example/{i}", page([f"one {i} &amp; <b>bold</b>\n  more", "two<br>lines"] * (i + 1))) for i in range(6)]
    rows.append((6, "http://a.example/6", page(["only"], extra="<div class='ad'>buy</div>", tail="")))
    rows.append((7, "http://b.example/7", page(["cut"], tail="")[:-60]))
    found = run(spark, rows)
    for i in range(6):
        expected = "\n".join(["A title", *[f"one {i} & bold more", "two lines"] * (i + 1)])
        assert (found[i].text, found[i].n_chars) == (expected, len(expected))
    assert found[6].text == "A title\nonly" and found[7].text == "A title\ncut"
    assert all(found[i].matched for i in range(6))


def test_hosts_without_an_article(spark):
    def plain_page(i):
        return (
            f"<body><div id=top><a href=/>home</a> <a href=/x>about {i}</a></div><div class=c><h2>Head {i}</h2>"
            f"<p>Long text number {i} of the page, with words.</p></div><div id=z>Same on all pages</div></body>"
        )

    found = run(spark, [(i, "http://c.example/", plain_page(i)) for i in range(5)])
    assert all(found[i].text == f"Head {i}\nLong text number {i} of the page, with words." for i in range(5))


def test_awkward_pages(spark):
    rows = [(1, None, None), (2, "", ""), (3, "not a url", "plain words"), (None, "http://d.example", page(["x"]))]
    rows += [(4, "http://d.example/", page(["twice"])), (4, "http://d.example/", page(["twice"]))]
    rows += [(5, "http://d.example/5", page(["word " * 60_000]))]
    result = wrappers.extract(table(spark, rows)).collect()
    assert len(result) == len(rows)
    texts = {r.page_id: r.text for r in result}
    assert texts[1] == texts[2] == "" and texts[4] == "A title\ntwice"
    assert texts[5] == "A title\n" + ("word " * 60_000).strip()
    assert plain(wrappers.extract(table(spark, []))) == []


def shape(page):
    return wrappers.page_shape(page)[0]


def outline(parts):
    """Parts as text: an element with its parts, * optional and repeated, + repeated, ? optional."""
    marks = {(True, True): "*", (True, False): "+", (False, True): "?", (False, False): ""}
    return " ".join(
        (f"({outline(p[3])})" if p[0] == "+" else p[0] + (f"[{outline(p[3])}]" if p[3] else "")) + marks[bool(p[1]), bool(p[2])] for p in parts
    )


def test_folding_and_merging():
    menu = "<ul>" + "<li>a" * 4 + "</ul>"
    assert outline(shape(menu)) == "ul[li[#]+]"
    assert outline(shape("<h2>a</h2><p>b<h2>c</h2><p>d<p>e")) == "(h2[#]? p[#]?)+"
    wrapper = wrappers.align([wrappers.counted(menu), wrappers.counted("<h1>x</h1><ul><li>b</ul>")])
    assert outline(wrapper) == "h1[#]? ul[li[#]+]"
    # Unnamed containers are told apart by what they hold.
    assert outline(shape("<div><a>l</a></div><div><p>t</div><div><p>t<p>u</div>")) == "div[@] div[p[#]+]+"


def expression(parts):
    """The wrapper as a regular expression over a page's tags and slots, written out plainly."""
    out = ""
    for label, repeated, optional, inner, _ in parts:
        if label in "#@":
            one = label
        elif label == "+":
            one = expression(inner)
        else:
            one = f"<{re.escape(label)}>{expression(inner)}</>"
        out += f"(?:{one})" + {(1, 1): "*", (1, 0): "+", (0, 1): "?", (0, 0): ""}[bool(repeated), bool(optional)]
    return out


def tokens(page):
    parts, _, unlinked = wrappers.parsed(page)

    def walk(parts):
        out = ""
        for part in parts:
            if isinstance(part, int):
                out += "#" if unlinked[part] else "@"
            elif walk(part[1]):
                out += f"<{part[0]}>{walk(part[1])}</>"
        return out

    return walk(parts)


def test_wrappers_match_the_streams_they_come_from():
    """Against a plain regular expression: the inferred wrapper matches each whole page of its host."""
    rng = random.Random(5)

    def part(depth):
        kind = rng.choice(["p", "p", "h2", "ul", "div", "div.c", "table"])
        if kind == "ul":
            return "<ul>" + "".join(f"<li>{rng.choice(['a', '<a href=x>l</a>'])}" for _ in range(rng.randrange(1, 4))) + "</ul>"
        if kind == "table":
            return "<table>" + "<tr><td>a<td>b" * rng.randrange(1, 4) + "</table>"
        if kind.startswith("div") and depth < 3:
            return f"<div{' class=c' if '.' in kind else ''}>" + "".join(part(depth + 1) for _ in range(rng.randrange(1, 4))) + "</div>"
        return f"<{kind[:2] if kind == 'h2' else 'p'}>text</{kind[:2] if kind == 'h2' else 'p'}>"

    for _ in range(40):
        pages = ["".join(part(0) for _ in range(rng.randrange(1, 5))) for _ in range(rng.randrange(1, 6))]
        wrapper = wrappers.align([wrappers.counted(p) for p in pages])
        for p in pages:
            assert re.fullmatch(expression(wrapper), tokens(p)), (pages, outline(wrapper))


def test_a_host_with_most_pages(spark):
    rows = [(i, "http://hot.example/", page([f"text {i}"])) for i in range(400)]
    rows += [(1000 + i, f"http://h{i}.example/", page([f"text {i}"])) for i in range(20)]
    found = run(spark, rows)
    assert len(found) == 420 and all(r.text == f"A title\ntext {i % 1000}" for i, r in found.items())


def test_inferred_spec_is_json():
    spec = json.dumps(wrappers.infer([page(["a"]), page(["b", "c"])]))
    assert wrappers.Reader().read(spec, page(["d"])) == ("A title\nd", True)


def test_names_of_whole_pages_and_forms_do_not_empty_a_text(spark):
    def named(i, before, after):
        return f"{before}<header class='entry-header'><h1>Head {i}</h1></header><p>Words of page {i}, long enough.</p>{after}"

    shells = {
        "b": ("<body class='has-sidebar no-comments'><article class='with-toc'>", "</article></body>"),
        "f": ("<body><form id='all'><main>", "</main></form></body>"),
        "s": ("<body><div class='right-sidebar'><article>", "</article></div><div class=x>a</div></body>"),
    }
    rows = [(100 * k + i, f"http://{k}.{n}/", named(i, *shells[n])) for k, n in enumerate(shells) for i in range(4)]
    found = run(spark, rows)
    for at, r in found.items():
        assert r.text == f"Head {at % 100}\nWords of page {at % 100}, long enough."


def test_slots_whose_texts_are_the_same_are_the_template(spark):
    """A slot of its own is told apart; one more paragraph of an article is not, however often it comes."""
    notes = "<div class=note>Sign up today</div>"
    rows = [(i, "http://t.example/", page([f"own words of page {i}", f"Under CC BY.{notes}"], title=f"T {i}")) for i in range(20)]
    found = run(spark, rows)
    assert all(r.text == f"T {i}\nown words of page {i}\nUnder CC BY." for i, r in found.items())


def test_names_inside_an_article_say_little(spark):
    def medical(i):
        inner = f"<section class='side-effects'><p>Effect {i}</section><section class='alert-levels'><p>Level {i}</section>"
        return f"<body><article><h1>Drug {i}</h1><p title=it's>Text {i}</p>{inner}<div class='comments'><p>hm {i}</div></article></body>"

    found = run(spark, [(i, "http://m.example/", medical(i)) for i in range(5)])
    assert all(r.text == f"Drug {i}\nText {i}\nEffect {i}\nLevel {i}" for i, r in found.items())


def test_long_irregular_and_deep_pages():
    rng = random.Random(1)
    names = ["p", "h2", "h3", "pre", "blockquote"]
    long = "<article>" + "".join(f"<{n}>{i}</{n}>" for i, n in enumerate(rng.choices(names, k=20_000))) + "</article>"
    deep = "<div>" * 5_000 + "<p>deep" + "</div>" * 5_000
    begin = time.perf_counter()
    spec = json.dumps(wrappers.infer([long, deep, page(["x"])]))
    reader = wrappers.Reader()
    assert reader.read(spec, long) == ("\n".join(str(i) for i in range(20_000)), True)
    assert reader.read(spec, deep) == ("deep", True)
    assert time.perf_counter() - begin < 20


def test_many_shapes_merge_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(wrappers, "BLOCK", 4)
    extras = [f"<div class={a}{b}>t {i}</div>" for i, (a, b) in enumerate((a, b) for a in "stuvw" for b in "stuvw")]
    rows = [(i, "http://w.example/", page([f"text {i}"], extra=extras[i])) for i in range(25)]
    found = run(spark, rows)
    assert all(r.text == f"A title\ntext {i}" and r.matched for i, r in found.items())


def test_labels_come_from_all_pages_of_a_host(spark):
    def listing(i):
        note = "Repeated words at the foot of pages, the same on every one of them"
        return f"<body><div class=w><p>Page {i} has varying words of its own here.</p></div><div class=z{i % 3}><p>{note}</p></div></body>"

    rows = [(i, "http://m.example/", page([f"text {i}"]) if i % 5 else listing(i)) for i in range(100)]
    found = run(spark, rows)
    for i in range(100):
        assert found[i].text == (f"A title\ntext {i}" if i % 5 else f"Page {i} has varying words of its own here.")


def test_wrapper_is_inferred_from_all_shapes_of_a_host(spark):
    extras = ["", "<table><tr><td>x</table>", "<dl><dt>y<dd>z</dl>", "<h4>w</h4>", "<pre>v</pre>", "<blockquote>u</blockquote>"]
    extras += [f"<div class=k{'abcdef'[i]}>t</div>" for i in range(6)]
    rows = [(i, "http://n.example/", page([f"text {i}"], extra=extras[i] if i < len(extras) else "")) for i in range(90)]
    found = run(spark, rows)
    assert all(r.matched for r in found.values())
