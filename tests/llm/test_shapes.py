"""Pages, chats, packing, mixing and URL filters."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from txvigil.llm import chats, mixing, packing, urls, wrappers
from txvigil.llm.common import components

# Pages


def text_of(html, *others):
    trees = [wrappers.parse(page) for page in (html, *others)]
    wrappers.induce(trees)
    return wrappers.main_text(trees[0])


def test_known_elements_go():
    html = """<!doctype html><head><title>T</title><style>p{}</style></head><body>
      <header>Top</header><nav><a>Home</a></nav><div class="cookie-notice">OK?</div>
      <article><header><h1>Head</h1></header><p><b>One&nbsp;&amp;
      two<br>three<p>Four <!-- no --> five<script>var x = "</p>";</script>
      <ul><li>six<li>seven</ul><form><p>Mail</form><aside>Side</aside></article>
      <section id="comments"><p>Nice!</section><footer>&copy;</footer>"""
    assert text_of(html) == "Head\nOne & two three\nFour five\nsix\nseven"
    assert text_of("") == text_of("<p></p>") == ""
    assert text_of("plain &lt;text") == "plain <text"


def test_constant_nodes_are_template():
    def page(i):
        return f"<body><div><p>Brand line</p></div><div><p>Story {i}</p><p>More {i}</p></div><div>Legal</div>"

    assert text_of(page(0), *map(page, range(1, 6))) == "Story 0\nMore 0"
    assert text_of(page(0)) == "Brand line\nStory 0\nMore 0\nLegal"


def test_tree_matching_takes_missing_and_new_parts():
    slot = wrappers.Slot("#page")
    wrappers.merge(wrappers.parse("<nav>a</nav><div><p>x</p></div><footer>f</footer>"), slot)
    assert wrappers.matching(wrappers.parse("<div><p>y</p></div><footer>f</footer>"), slot) == 6
    wrappers.merge(wrappers.parse("<nav>a</nav><h2>new</h2><div><p>y</p></div>"), slot)
    assert [s.tag for s in slot.children] == ["nav", "h2", "div", "footer"]


def test_copied_articles_stay():
    page = "<body><article><h1>Same</h1><p>Copied text</p></article>"
    assert text_of(page, *[page] * 30) == "Same\nCopied text"


@pytest.mark.parametrize("name", ["content has-sidebar", "no-sidebar", "layout-side", "hidden-xs", "page-form", "sidebar", "widget-area"])
def test_class_words_do_not_remove_the_article(name):
    story = "<p>A story of some length</p>"
    aside = '<div class="sidebar">Ad</div><div id="site-footer">Foot</div>'
    for around in (f"<article>{story}</article>", f"<main>{story}</main>", story):
        assert text_of(f'<body><div class="{name}">{around}</div>{aside}') == "A story of some length"
    for inside in (f'<article><div class="{name}">{story}</div></article>', f'<main><div id="{name}">{story}</div></main>'):
        assert text_of(f"<body>{inside}{aside}") == "A story of some length"
    assert text_of(f'<body><article>{story}<div class="sidebar">{story * 3}</div></article>') == "A story of some length"


@pytest.mark.parametrize(
    "icon", ["<svg a='/' />", "<math/>", "<object data='x'>", "<select>", "<svg><path d='x'/><text>t</text></svg>", "<iframe src='x'/>"]
)
def test_elements_without_end_take_no_text(icon):
    assert text_of(f"<body><p>One {icon} two</p><p>three</p>") == "One two\nthree"


def test_copies_of_a_page_lose_the_same_blocks():
    pages = [f"<body><div><p>Brand line</p></div><div><p>Story {i % 5}</p></div>" for i in range(12)]
    trees = [wrappers.parse(page) for page in pages]
    wrappers.induce(trees)
    assert [wrappers.main_text(tree) for tree in trees] == [f"Story {i % 5}" for i in range(12)]


@pytest.mark.parametrize("partitions", [1, 7])
def test_all_pages_of_a_host_share_one_wrapper(spark, partitions):
    def page(i):
        tags = "<p>Rare</p><ul><li>Box" if i % 7 == 3 else ""
        return f"<body><div><p>Brand line</p></div><section><p>Story {i}</p></section>{tags}"

    rows = [(i, f"http://h{i % 2}.com/{i}", page(i)) for i in range(2 * 67)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
        found = {r.page_id: r.text for r in wrappers.extracted(pages).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found == {i: f"Story {i}" for i, _, _ in rows}


@pytest.mark.parametrize("salt", "ac")
def test_parts_that_few_pages_of_a_host_have_are_in_its_wrapper(spark, salt):
    def page(i):
        more = f"<table><tr><td>Cell {i}</table>" if i % 200 < 100 else ""
        rare = f"<section><table><tr><td>Legal</table><ul><li>Item {i}</ul>{more}</section>"
        return f"<div><p>Story {salt} {i}</div>" + (rare if i % 100 == 0 else "")

    pages = [(i, "http://a.org/", page(i)) for i in range(800)]
    found = wrappers.extracted(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert not [r.page_id for r in found if "Legal" in r.text]
    assert sum("Item" in r.text for r in found) == 8


def test_wrappers_are_merged_in_rounds(spark):
    def page(i):
        return "".join(f"<{tag}>x</{tag}>" for n, tag in enumerate(("h1", "ul", "dl", "table", "pre")) if n != i % 7)

    bodies = [page(i) + f"<section><{tag}>y</{tag}></section>" for i in range(7) for tag in ("p", "pre", "ol")]
    packed = [wrappers.marshal.dumps(wrappers.shape(wrappers.parse(body)), 2) for body in bodies]
    shapes = spark.createDataFrame([("a", p) for p in packed] + [("b", packed[0])] * 9, "host string, shape binary")
    for dealt in (shapes.repartition(7), shapes.coalesce(1)):
        found = {r.host: r.wrapper for r in wrappers.induced(dealt, 2).collect()}
        assert sorted(found) == ["a", "b"]
        for body in bodies:
            tree = wrappers.parse(body)
            whole = wrappers.matching(tree, wrappers.wrapper_of([tree]))
            assert wrappers.matching(tree, wrappers.unpacked_slots(wrappers.marshal.loads(found["a"]))) == whole
        assert found == {r.host: r.wrapper for r in wrappers.induced(shapes, 2).collect()}


def test_pages_of_odd_rows(spark):
    rows = [(1, "http://a.com/x", None, 1), (2, None, "", 1), (3, "no url", "<p>a", 1), (3, "no url", "<p>a", 1),
            (None, "http://a.com/y", "<p>b</p>" * 3, 1), (5, "http://a.com/z", "<" * 5000, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    found = Counter((r.page_id, r.text) for r in wrappers.extracted(pages).collect() if r.page_id != 5)
    assert found == {(1, ""): 1, (2, ""): 1, (3, "a"): 2, (None, "b\nb\nb"): 1}
    assert wrappers.extracted(pages.filter("false")).collect() == []


def test_deep_pages(spark):
    deep = "<div>" * 10_000 + "<nav>menu<div>deep</div></nav><p>%s</p>" + "tail</div>" * 10_000
    pages = [(i, f"http://a.com/{i}", deep % f"story {i}") for i in range(2)]
    found = wrappers.extracted(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in found} == {i: "\n".join([f"story {i}", *["tail"] * 10_000]) for i in range(2)}


def test_blocks_below_the_deepest_node_keep_their_order():
    inner = "<div>one<div>two</div>three<aside>never<p>never</p></aside></div><form>never<div>never</div></form>four"
    for depth in (3, wrappers.DEPTH - 1, wrappers.DEPTH, wrappers.DEPTH + 1, 600):
        assert text_of("<div>" * depth + inner) == "one\ntwo\nthree\nfour"


def test_wide_pages():
    def page(own, shift):
        pairs = [f"<p>a{own} {k}</p><ul><li>b{own} {k}</ul>" for k in range(5000)]
        return "<ul><li>first</ul>" * shift + "".join(pairs) + "<pre>same</pre>"

    found = text_of(page(0, 1), *(page(i, i % 2) for i in range(1, 5)))
    blocks = found.split("\n")
    assert [b for b in blocks if b[0] in "ab"] == [f"{c}0 {k}" for k in range(5000) for c in "ab"]
    assert "same" not in blocks


def test_nearest_slots():
    runs = [[wrappers.Node(tag)] for tag in ("p", "ul", "h2", "p", "pre", "p")]
    slots = [wrappers.Slot(tag) for tag in ("p", "pre", "h2", "ul", "p", "ul", "p")]
    assert wrappers._nearest(runs, slots) == [0, 3, None, 4, None, 6]


# Chats


@pytest.mark.parametrize("text", ["", "a", "\\", "### user: x</turn>\n", "\\### Assistant: </turn> ok", "\\\\#<:\n"])
def test_turns_are_reversible(text):
    written, first, last = chats.formatted(text, text)
    assert chats.parsed(written * 2) == [(text, text)] * 2
    assert chats.unescaped(written[first:last]) == text


def conversations(spark, talks):
    rows = [(c, n, role, text) for c, turns in talks.items() for n, (role, text) in enumerate(turns)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)


def test_prefix_tree(spark):
    dice = random.Random(6)
    talks = {}
    for conv in range(60):
        turns = [("system" if i == 0 else ("user", "assistant")[i % 2], dice.choice(["hi", "yo#", "<x>"])) for i in range(dice.randint(1, 6))]
        talks[conv] = turns
    nodes, steps, ends = chats.prefix_tree(conversations(spark, talks))
    laid = sorted(nodes.collect(), key=lambda r: r.offset)
    # Every shared beginning is laid out once, one after another.
    beginnings = {tuple(t[: i + 1]) for t in talks.values() for i in range(len(t))}
    assert len(laid) == len(beginnings)
    assert [r.offset for r in laid] == [sum(r.length for r in laid[:i]) for i in range(len(laid))]
    stream = "".join(r.written for r in laid)
    by_id = {bytes(r.node): r for r in laid}
    for node in laid:
        seen = "".join(stream[s["from"] : s["to"]] for s in node.ancestors)
        assert len(seen) == node.position
        if node.parent is not None:
            parent = by_id[bytes(node.parent)]
            assert seen.endswith(parent.written) and parent.depth == node.depth - 1
            assert parent.offset < node.offset
    for end in ends.collect():
        leaf = by_id[bytes(end.leaf)]
        whole = "".join(stream[s["from"] : s["to"]] for s in leaf.ancestors) + leaf.written
        assert chats.parsed(whole) == talks[end.conv_id]
    for row in chats.read_back(nodes, steps, ends).collect():
        turns = talks[row.conv_id]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert row.n_turns == len(turns) and row.loss_chars == len(loss)
        assert row.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert row.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert row.formatted_chars == sum(len(chats.formatted(r, t)[0]) for r, t in turns)


def test_chats_of_odd_rows(spark):
    rows = [(None, 0, "user", "a"), (1, None, None, None), (1, 0, "user", ""), (1, 0, "user", ""), (2, 5, "user", "x" * 99_999)]
    talks = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("node", F.lit(1))
    nodes, steps, ends = chats.prefix_tree(talks)
    assert {(r.conv_id, r.n_turns) for r in chats.read_back(nodes, steps, ends).collect()} == {(None, 1), (1, 3), (2, 1)}
    nodes, steps, ends = chats.prefix_tree(talks.filter("false"))
    assert nodes.collect() == ends.collect() == []


# Packing


@pytest.mark.parametrize("lengths", [[1], [2048], [5000, 3, 3, 2047], [1] * 700, [7, 100, 2049, 30_000]])
def test_pack(lengths):
    pieces = list(packing.pack(lengths))
    ranges, filled = defaultdict(list), defaultdict(list)
    for document, start, n, sequence, offset in pieces:
        assert n > 0
        ranges[document].append((start, n))
        filled[sequence].append((offset, n))
    for document, own in ranges.items():
        at = 0
        for start, n in sorted(own):
            assert start == at
            at += n
        assert at == lengths[document]
    sizes = []
    for own in filled.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        sizes.append(at)
    assert all(size == 2048 or size & (size - 1) == 0 for size in sizes)
    assert sum(sizes) == sum(lengths)


def test_costs_are_balanced():
    """Short pieces keep clear of sequences that long pieces have made dear."""
    cost = Counter()
    for _, _, n, sequence, _ in packing.pack([1500] * 8 + [60] * 400):
        cost[sequence] += n + n * n / packing.QUADRATIC
    full = sorted(cost.values())[3:]  # without the three at smaller powers of two
    assert full[-1] < 1.5 * full[0]


def test_ids_are_the_tokenizers(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    dice = random.Random(7)
    texts = ["", "a <|endoftext|>b", "<|endoftext|>", "naïve\u00a0 x\n\n y  ", "１２ ٣ Ⅷ 漢字", "\u200b\u0301\U0001f600 \x00"]
    texts += ["".join(chr(dice.choice([32, 10, dice.randint(33, 126), dice.randint(160, 0x2FFF)])) for _ in range(200)) for _ in range(200)]
    for text in texts:
        assert packing.token_ids(text).tolist() == [*own.encode(text, add_special_tokens=False).ids, 1]


def test_packing_of_odd_rows(odd, none):
    rows = packing.packed(odd).collect()
    assert Counter(r.doc_id for r in rows if r.start == 0)[5] == 2
    assert {(r.doc_id, r.doc_tokens) for r in rows if r.doc_id in (2, 3)} == {(2, 1), (3, 1)}
    assert packing.packed(none).collect() == []


# Mixing


def test_targets_stop_at_three_times(spark):
    patterns = spark.createDataFrame([(["sa"], 10), (["sb"], 500), (["sc"], 90), (["n"], 400)], "pattern array<string>, capacity long")
    goals = {r.key: r.target for r in mixing.targets(patterns).collect()}
    assert goals["sa"] == 30
    rest = 1000 - 30
    assert goals == pytest.approx({"sa": 30, "sb": rest * 2 / 8, "sc": rest / 8, "n": rest * 5 / 8})


def test_flow_repeats_as_little_as_possible():
    # The second source has words of its own; the shared ones are left to the first.
    flow = mixing.min_cost_flow([100, 100], [[0, 1], [1]], [150, 100])
    assert flow == {(0, 0): 150, (1, 1): 100}
    assert sum(mixing.min_cost_flow([10], [[0]], [50]).values()) == 30


def test_overlapping_sources(spark):
    dice = random.Random(8)
    rows = [(i, " ".join(["w"] * dice.randint(1, 40)), dice.choice([["a"], ["b"], ["a", "b"], ["b", "c"], [None], []])) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, members array<string>")
    taken, sources = mixing.mix(docs, F.col("members"))
    rows_taken, goals = taken.collect(), {r.key: r for r in sources.collect()}
    assert all(r.copies <= 3 for r in rows_taken)
    assert len(rows_taken) == 600 and {r.copies for r in rows_taken if not r.pattern} == {0}
    whole = sum(r.size * r.copies for r in rows_taken)
    assert whole == pytest.approx(sum(r.target for r in goals.values()), rel=0.02)
    again = mixing.mix(docs.repartition(7), F.col("members"))[0]
    assert {(r.doc_id, r.copies) for r in again.collect()} == {(r.doc_id, r.copies) for r in rows_taken}


def test_mixing_of_odd_rows(odd, none):
    taken, sources = mixing.mix(odd, F.array("source"))
    assert taken.count() == odd.count()
    assert {r.key for r in sources.collect()} == {"sa", "sb", "sc", "n"}
    taken, sources = mixing.mix(none, F.array("source"))
    assert taken.collect() == sources.collect() == []


# URL filters and components


def test_urls(spark):
    rows = [
        (1, "HTTP://A.Example.ORG/es/x?q#f", None), (2, "http://example.org/en/12", ""), (3, "https://b.com/de/1", None),
        (4, None, None), (5, "no scheme", None), (6, "x://", None), (7, "http://c.net", '<a href="http://b.com/">'),
        (8, "http://d.net/?/fr/", "<a HREF='//www.example.org/x'>"), (9, "http://notexample.org/es/", None),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("rule", F.lit(1))
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judged(pages).collect()}
    assert found[1] == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert found[2] == ("example.org", "/en/12", "example.org/en/1", "block")
    assert found[3] == ("b.com", "/de/1", "com/de/", "block")
    assert found[4] == found[5] == ("", "", None, "allow")
    assert found[6] == ("", "", None, "allow")
    assert found[7] == ("c.net", "", None, "block")  # it links to a blocked host
    assert found[8] == ("d.net", "/", None, "allow")
    assert found[9] == ("notexample.org", "/es/", "org/", "allow")
    assert urls.judged(pages.filter("false")).collect() == []


def test_verdicts_do_not_depend_on_size(spark):
    """Scores of large inputs are tiny: shares of millions of pages, spread over a thousand hosts."""
    rows = [("a", "block", 4e-11), ("b", "block", 5e-300), ("b", "allow", 4e-300), ("c", "block", 4e-11),
            ("c", "allow", 4e-11 * (1 + 1e-13)), ("d", "block", 0.3 * (1 + 1e-13)), ("d", "allow", 0.3),
            ("e", "allow", 1e-12), ("f", "block", 0.0)]
    for scale in (1, 1e-6):
        scaled = [(host, kind, score * scale) for host, kind, score in rows]
        scores = spark.createDataFrame(scaled, "host string, kind string, score double")
        found = {r.host: r.blocked for r in urls.host_verdicts(scores).collect()}
        assert found == {"a": True, "b": True, "c": False, "d": False, "e": False, "f": False}


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 99), (99, 98), (50, 51)]
    links = spark.createDataFrame(chain, "a long, b long")
    found = {r.node: r.component for r in components(links).collect()}
    assert found == {**{i: 0 for i in range(41)}, 98: 98, 99: 98, 100: 98, 50: 50, 51: 50}


def test_distrust_reaches_the_end_of_a_chain(spark):
    """A chain of 30 hosts, each linking to the next, the last one to a blocked host."""
    hosts = [f"h{n}.test" for n in range(30)] + ["bad.test"]
    rows = [(n, f"http://{a}/x", f'<a href="http://{b}/">x</a>', True) for n, (a, b) in enumerate(zip(hosts, hosts[1:]))]
    rows.append((99, "http://bad.test/no/", None, False))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, blocked boolean")
    found = urls.judged(pages, (urls.UrlRule("block", "bad.test", "/no/"),))
    assert {r.verdict for r in found.collect()} == {"block"}
    assert {r.page_id: r.blocked for r in found.collect()} == {row[0]: row[3] for row in rows}
    assert urls.judged(pages.filter("false")).count() == 0
