import time
import random
import pytest

from tabledocs.llm.main_text import MainTextOptions, lines_of, main_text, main_texts, stretches


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("just text &amp; more", "just text & more"),
        ("<html><head><title>t</title></head><body><nav><a href='/'>Home</a></nav><article><h1>A &lt; B</h1><p>One<br>two\n three<p><b>four</article><footer>&copy;</footer>",
         "A < B\n\nOne two three\n\nfour"),
        ("<header>Site</header><main><p>x</p><aside>y</aside><form>z</form><div class='ad-box ad'>w</div><p>v</main><section id=comments><p>first!</section>", "x\n\nv"),
        ("<body><div class='cookie-notice'><p>We use cookies and more of them</div><p>Story here.</p><script>if(a<b){'</p>'}</script><ul><li>a<li>b</ul>", "Story here.\n\na\n\nb"),
        ("<article><p>say &quot;hi&quot; <a href='x'>link</a> now</p><!-- <p>no</p> --><p>5 > 3 &#233;</p></article>", 'say "hi" link now\n\n5 > 3 é'),
        ("<article><header><h1>Head</h1></header><p>p</p></article><div role='complementary'>side</div>", "Head\n\np"),
        ("<article><p>only", "only"), ("<style>p{}</style><script>x", ""),
    ],
)
def test_pages(page, text):
    assert main_text(page) == text


def test_lines_and_stretches():
    assert [(x.text, x.weight, x.aside) for x in lines_of("<nav><a>m</a></nav><p>a <a href=q>bc</a></p>")] == [("m", 0, True), ("a bc", 1, False)]
    assert stretches([0, 0, 5, 0, 4, 0, 0, 0, 3], MainTextOptions(surge=1)) == [(2, 5), (8, 9)]
    assert stretches([2, 0, 0, 0], MainTextOptions(surge=3)) == []


def test_table(spark):
    rows = [(1, "u", "<p>é</p>"), (1, "u", "<p>é</p>"), (None, None, None), (2, "v", "<p>" + "word " * 100_000)]
    got = sorted(tuple(r) for r in main_texts(spark.createDataFrame(rows, "page_id bigint, url string, html string")).fillna(-1, ["page_id"]).fillna("", ["url"]).collect())
    assert [(a, b, n) for a, b, _, n in got] == [(-1, "", 0), (1, "u", 1), (1, "u", 1), (2, "v", 499_999)]


LONG = "A paragraph of the article with words enough to be found by the blocks."


@pytest.mark.parametrize(
    ("page", "expected"),
    [
        (f'<article><h1><a href="x">Title</a></h1><p>{LONG}</p><p><a href="y">The whole last paragraph is one link</a></p></article>', ["Title", LONG, "The whole last paragraph is one link"]),
        (f"<article><p>{LONG}</p><ul><li><a>one</a><li><a>two</a><li><a>three</a></ul><p>{LONG}</p></article>", [LONG, "one", "two", "three", LONG]),
        (f'<div class="long-form"><p>{LONG}</p></div>', [LONG]),
        (f'<article><p title="the hidden valley">{LONG}</p><div class="share-price">Shares rose.</div><p class="alert">Take care.</p><label>Box</label></article>', [LONG, "Shares rose.", "Take care.", "Box"]),
        (f'<div class="comments"><p>{LONG}</p></div><div class="site-footer ad-slot">{LONG}</div><p hidden>{LONG}</p><div role=navigation>{LONG}</div>', []),
        (f"<article><p>Short teaser.</p></article><div><p>{LONG}</p><p>{LONG}</p></div>", ["Short teaser.", LONG, LONG]),
        (f"<article><p>{LONG}</p></article><div><p>Beside it.</p></div>", [LONG]),
        ("<p>Short.</p>", ["Short."]),
        (f"<ul><li><a>Home</a><li><a>News</a><li><a>Sport</a><li><a>More</a></ul><p>{LONG}</p>", [LONG]),
        (f"<p>{LONG} <a \"x>y</a> 1 < 2 & 3</p><p class='a>b'>{LONG}</p>", [f"{LONG} y 1 < 2 & 3", LONG]),
        (f"<p>{LONG}</p><p>open <b", [LONG, "open <b"]),
    ],
)
def test_pages(page, expected):
    assert main_text(page) == "\n\n".join(expected)


@pytest.mark.parametrize("unit", ["<a ", '<a "', "<font>", '<a ="', "<b>x", "< ", "<svg>", "<!-- ", "<div>", '<a x=">"', "<a>x", "</p>", "<p>x"])
def test_work_is_linear(unit):
    """A megabyte of any of these is read in seconds: nothing is searched for twice."""
    start = time.perf_counter()
    main_text(unit * (1_000_000 // len(unit)))
    assert time.perf_counter() - start < 5


def test_stretches_against_window_sums():
    """A stretch begins at a line with text whose block, summed up by itself, reaches the surge, and lasts until a block below the dive."""
    rng = random.Random(6)
    for _ in range(500):
        weights = [rng.choice([0, 0, rng.randrange(12)]) for _ in range(rng.randrange(25))]
        options = MainTextOptions(window=rng.randrange(1, 5), surge=rng.randrange(1, 25), dive=rng.randrange(1, 4))
        blocks = [sum(weights[k : k + options.window]) for k in range(len(weights))]
        surge = max(options.surge, options.dive)
        inside, expected = False, set()
        for k, block in enumerate(blocks):
            inside = block >= options.dive if inside else bool(weights[k]) and block >= surge
            if inside:
                expected.add(k)
        assert {k for a, z in stretches(weights, options) for k in range(a, z)} == expected
