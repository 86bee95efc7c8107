"""Blocks of broken markup, held-out accuracy on labelled pages, and odd rows."""

from llm.html_extract import blocks_of, default_field, extract, features, labelled_rows, main_text
from llm.labelled_pages import Page


def texts(html):
    return [b.text for b in blocks_of(html)]


def test_blocks():
    assert texts("<p>a <b>b<p>c&amp;d&nbsp; e<br>f</p>g") == ["a b", "c&d e f", "g"]
    assert texts("<script>x='</p>'</script><style>p{}</style><!-- <p>no --><p>yes") == ["yes"]
    assert texts("<ul><li>1<li>2</ul><td>3<p title='a>b'>4</p></x><p>5 < 6") == ["1", "2", "3", "4", "5 < 6"]
    assert texts("<p>whole</p><p>cut &am") == ["whole", "cut &am"] and texts("<p>a</p><p cla") == ["a"]
    assert texts("<script>never closed <p>a") == [] and texts("") == [] and texts("<!-- open <p>a") == []
    assert [tag for tag, _ in blocks_of("<article><p>a<div>b</div></article>")[1].path] == ["article", "div"]


def test_held_out_pages():
    field, wrong, total = default_field(), 0, 0
    for seed in range(9000, 9120):
        rows, labels = next(labelled_rows([Page(seed)]))
        found = field.decode(rows)
        wrong += sum(bool(a) != bool(b) for a, b in zip(found, labels, strict=True))
        total += len(labels)
    assert wrong <= 0.02 * total


def test_viterbi_is_the_best_path():
    import itertools

    field = default_field()
    rows = features(blocks_of("<nav><a href=x>Home</a></nav><article><h1>Head</h1><p>Some words here.</p><div class=ad>Buy</div></article><footer>c</footer>"))
    unary = [field.weights[[field.index[f] for f in row if f in field.index]].sum(axis=0) for row in rows]
    score = lambda ys: field.start[ys[0]] + sum(u[y] for u, y in zip(unary, ys, strict=True)) + sum(field.steps[a, b] for a, b in zip(ys, ys[1:], strict=False))
    best = max(itertools.product([0, 1], repeat=len(rows)), key=score)
    assert [bool(y) for y in best] == field.decode(rows)


def test_a_page_and_odd_rows(spark):
    html = (
        "<html><head><title>T</title></head><body><nav><ul><li><a href=/x>Home</a></li></ul></nav><div class='ad'>Buy now.</div>"
        "<article><h1>Head</h1><p>One  two\n three.</p><div class=sidebar><p>Read more.</p></div><p>" + "four " * 50_000 + "</p></article>"
        "<section class=comments><div class=comment><p>I disagree with all of this, my friends.</p></div></section><footer>&copy; x</footer></body></html>"
    )
    want = "Head\nOne two three.\n" + ("four " * 50_000).strip()
    assert main_text(html, default_field()) == want
    rows = [(1, "u", html, "x"), (1, "u", html, "x"), (2, None, None, "x"), (3, "u", "", "x"), (None, "u", "<nav>a</nav>", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = [tuple(r) for r in extract(pages).collect()]
    assert found == [(1, "u", want, len(want))] * 2 + [(2, None, "", 0), (3, "u", "", 0), (None, "u", "", 0)]
    assert extract(pages.limit(0)).collect() == []


def test_only_scripts_styles_and_fields_hold_no_blocks():
    texts = lambda html: [b.text for b in blocks_of(html)]
    assert texts("<p>a</p><noscript><p>b</p></noscript><template><p>c</p></template><object><p>d</p></object>") == ["a", "b", "c", "d"]
    assert texts("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p><p>e</p>") == ["so x=2 holds", "e"]
    assert texts('<p>f <svg viewBox="0"><text>g</text><p>h</p>') == ["f g", "h"]
    for open_ in ("svg", "object", "noscript", "iframe", "template", "math"):
        assert texts(f"<article><p>i</p><{open_}><p>j</p><p>k</p></article>")[-2:] == ["j", "k"]
    assert texts("<p>l</p><script>var m = '<p>n</p>'</script><style>o</style><textarea>q</textarea><p>r <svg/>s</p>") == ["l", "r s"]
