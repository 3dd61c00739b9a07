"""The training-data operators on small made-up inputs, against plain versions of what they compute."""

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from clausemill.llm import (
    chosen_path,
    line_spread,
    mixing,
    norm_topk,
    page_wrappers,
    personal_data,
    piece_sampling,
    quality_rules,
    url_rules,
    warc_archives,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ["row", "key", "words", "lines", "kept", "position", "gone", "id", "clean", "member", "block", "pieces"]


def prose(seed, n=80):
    r = random.Random(seed)
    return " ".join(f"{r.choice('bcdfglmnprst')}{r.choice('aeiou')}{r.randrange(900)}" for _ in range(n)) + "."


def odd_docs(spark, clashing=False):
    """Nulls, empty and long texts, repeated rows, copies."""
    rows = [
        (1, prose(1), "en", "a", 5),
        (1, prose(1), "en", "a", 5),
        (2, None, None, None, None),
        (3, "", "en", "b", 0),
        (None, prose(2), "en", None, 7),
        (4, " \n\t \n", "en", "b", 6),
        (5, prose(1), "en", "c", 5),
        (6, prose(3, 30_000), "en", "c", 5),
        (7, "a b", "en", "c", 3),
        (8, prose(4) + "\nmenu\nHome | News | Contact\n" + prose(5), "en", "d", 1),
    ]
    docs = spark.createDataFrame(rows, DOCS)
    return docs.withColumns({c: F.lit(c) for c in CLASHING}) if clashing else docs


STAGES = {
    "quality": quality_rules.clean,
    "lines": line_spread.clean,
    "near": chosen_path.dedup,
    "mix": lambda docs: mixing.mixed(docs, {"a": 2, "b": 1}),
}


@pytest.mark.parametrize("name", STAGES)
def test_stages_keep_columns_and_take_odd_rows(spark, name):
    docs = odd_docs(spark, clashing=True)
    out = STAGES[name](docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert Counter(r.doc_id for r in rows) <= Counter(r.doc_id for r in docs.collect())
    assert all(r[c] == c for r in rows for c in CLASHING)
    assert STAGES[name](docs.limit(0)).collect() == []


def test_quality_rules(spark):
    rows = {r.row.doc_id: r for r in quality_rules.judge(odd_docs(spark).where("doc_id = 8 OR doc_id = 6 OR doc_id = 2")).collect()}
    assert rows[8].kept and rows[8].n_failed_lines == 2
    assert rows[8].clean == prose(4) + "\n" + prose(5)
    assert rows[2].n_words == 0 and not rows[2].kept
    assert rows[6].n_words == 30_000
    shouting = " ".join(w + "!!" for w in prose(9).split())
    docs = spark.createDataFrame([(1, shouting, "", "", 0), (2, "x y z " * 40, "", "", 0), (3, "- a - b\n" + prose(7), "", "", 0)], DOCS)
    kept = {r.row.doc_id: (r.kept, r.base_failed) for r in quality_rules.judge(docs).collect()}
    assert kept == {1: (False, False), 2: (False, True), 3: (True, False)}


def test_line_spread(spark):
    shared = "Read more about our valley and its mills."
    rows = [(i, f"{prose(i)}\n  {shared} \n{prose(100 + i)}", "en", f"s{i % 7}", 0) for i in range(14)]
    rows += [(20 + i, prose(999), "en", f"s{i}", 0) for i in range(6)]  # copies on many sites stay whole
    rows += [(30, f"{prose(30)}\n{shared}", "en", None, 0), (31, None, "en", "s1", 0)]
    out = {r.row.doc_id: r for r in line_spread.dedup(spark.createDataFrame(rows, DOCS)).collect()}
    assert out[3].clean == f"{prose(3)}\n{prose(103)}" and out[3].n_boilerplate == 1
    assert out[22].clean == prose(999) and out[22].kept_whole
    assert out[30].clean == prose(30) and out[31].clean is None
    sites = line_spread.spread(spark.createDataFrame(rows, DOCS), min_sites=7).collect()
    assert [r.n_sites for r in sites] == [7]


def test_shared_lines_go_from_documents_with_a_line_of_their_own(spark):
    """Whatever their share; only documents of nothing but shared lines stay whole."""
    shared = [prose(700), prose(701)]
    rows = [(i, f"{shared[0]}\nOwn words {i}.\n{shared[1]}", "en", f"s{i}", 0) for i in range(5)]
    rows += [(9, "\n".join(shared), "en", "s9", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    out = {r.row.doc_id: r for r in line_spread.dedup(docs).collect()}
    assert all(out[i].clean == f"Own words {i}." and not out[i].kept_whole for i in range(5))
    assert out[9].clean == "\n".join(shared) and out[9].kept_whole
    assert {r.doc_id: r.text for r in line_spread.clean(docs).collect()} == {i: r.clean for i, r in out.items()}


def test_mixing_is_within_a_block_of_its_weights(spark):
    parts = {"a": 5, "b": 2, "c": 1}
    names = ["a"] * 900 + ["b"] * 400 + ["c"] * 300 + [None] * 200
    docs = spark.createDataFrame([(i, "", "", s, 0) for i, s in enumerate(names)], DOCS)
    rows = sorted(mixing.mix(docs, parts, block_rows=10).collect(), key=lambda r: r.position)
    assert [r.position for r in rows] == list(range(len(names)))
    weights = {**parts, None: 1}
    total, seen = sum(weights.values()), Counter()
    for r in rows[:900]:  # before the first source runs out
        assert r.release <= r.slot < r.deadline
        seen[r.row.source if r.row.source in parts else None] += 1
        n = sum(seen.values())
        assert all(abs(seen[s] - n * w / total) < 2 * 10 for s, w in weights.items())
        if n % 10 == 0:
            assert all(abs(seen[s] - n * w / total) < 10 for s, w in weights.items())
    again = mixing.mix(docs.repartition(7), parts, block_rows=10).select("row.doc_id", "position").collect()
    assert {(r.row.doc_id, r.position) for r in rows} == {tuple(r) for r in again}


def test_sampled_pieces(spark):
    vocabulary = piece_sampling.Vocabulary()
    sampler = piece_sampling.Sampler(vocabulary)
    weight = {text: (rank + piece_sampling.RANK_SHIFT) ** -piece_sampling.ALPHA for text, _, rank in vocabulary.pieces}

    def paths(rest):
        if not rest:
            yield (), 1.0
        for n in range(1, len(rest) + 1):
            if rest[:n] in weight:
                for path, value in paths(rest[n:]):
                    yield (rest[:n], *path), weight[rest[:n]] * value

    every = dict(paths(" mills"))
    n = 40_000
    pieces, counts = sampler.sample([" mills"] * n, np.arange(n).astype(np.uint64), np.zeros(n, dtype=np.int64))
    ends = np.cumsum(counts)
    seen = Counter(tuple(vocabulary.bytes[p].decode() for p in pieces[e - c : e]) for e, c in zip(ends, counts, strict=True))
    total = sum(every.values())
    assert set(seen) <= set(every)
    assert all(abs(seen[p] / n - v / total) < 0.01 for p, v in every.items())


def test_encoding_is_lossless_and_repeatable(spark):
    texts = ["", " ", "  a  b \n\n c", "▁ ▁▁x", "梦😀ң é\x00\x7f", "x" * 5000, prose(1, 20_000), None, "\n", "a\n  "]
    docs = spark.createDataFrame([(i, t, "", "", 0) for i, t in enumerate(texts)] + [(None, "no id", "", "", 0)], DOCS)
    rows = piece_sampling.encode(docs).collect()
    assert all(r.lossless for r in rows if r.pieces is not None)
    by_id = {r.doc_id: r.pieces for r in rows}
    assert by_id[7] is None and by_id[0] == []
    decoded = piece_sampling.encode(docs).select("doc_id", piece_sampling.decode(F.col("pieces"), piece_sampling.Vocabulary()).alias("t"))
    assert {r.doc_id: r.t for r in decoded.collect()} == {**dict(enumerate(texts)), None: "no id"}
    again = {r.doc_id: r.pieces for r in piece_sampling.encode(docs.repartition(5)).collect()}
    assert again == by_id
    assert {r.doc_id: r.pieces for r in piece_sampling.encode(docs, seed=1).collect()}[6] != by_id[6]


def test_a_sampler_stays_small_over_many_distinct_units():
    sampler = piece_sampling.Sampler(piece_sampling.Vocabulary())
    largest = 0
    for part in range(8):  # 2.4 million characters in units that do not repeat
        texts = [" ".join(f"unit{(part * 20 + row) * 1000 + k:08d}ends" for k in range(1000)) for row in range(20)]
        sampler.encode(texts, np.arange(20).astype(np.uint64))
        largest = max(largest, sum(v.nbytes for v in vars(sampler).values() if isinstance(v, np.ndarray)))
    assert largest < 50_000_000


def test_archives_round_trip(spark):
    page = "<p>" + "é" * 80 + "</p>"
    rows = [(3, "http://a/x y%20\r\n", page), (1, None, page), (2, "u", None), (4, "u", "s"), (5, "v", "s"), (None, "n", page), (6, "w", page + "!")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit(1))
    folder = warc_archives.archive_folder(spark)
    index = warc_archives.write(pages, folder)
    records = {r.record_id: r for r in warc_archives.resolved(warc_archives.read(index, folder)).collect()}
    assert {k: (r.record_type, r.refers_to) for k, r in records.items()} == {
        1: ("response", None), 3: ("revisit", 1), 2: ("response", None), 4: ("response", None), 5: ("response", None),
        None: ("response", None), 6: ("response", None),
    }
    for number, url, body in rows:
        r, payload = records[number], (body or "").encode()
        assert (r.url, bytes(r.payload), r.payload_bytes) == (url, payload, len(payload))
        assert r.payload_digest == hashlib.sha256(payload).hexdigest()
    one = warc_archives.read(index.where("record_id = 6"), folder).collect()
    assert [r.record_id for r in one] == [6]
    empty = warc_archives.archive_folder(spark)
    assert warc_archives.read(warc_archives.write(pages.limit(0), empty), empty).collect() == []


def test_byte_ranges_are_coalesced():
    far = warc_archives.GAP_BYTES + 1
    entries = [(0, 10), (10, 5), (20, 5), (25 + far, 4)]
    assert list(warc_archives._coalesced(entries)) == [(0, 3, 0, 25), (3, 4, 25 + far, 29 + far)]
    assert list(warc_archives._coalesced([])) == []


@pytest.mark.parametrize("spread", [0.0, 1.0])
def test_top_k_is_exact(spark, monkeypatch, spread):
    """Also with vectors of very different lengths, where buckets and coordinates prune."""
    for name, value in (("BLOCK_ROWS", 50), ("QUERY_ROWS", 20), ("SEED_ROWS", 40), ("COORDINATE_FROM", 0.3)):
        monkeypatch.setattr(norm_topk, name, value)
    r = np.random.default_rng(5)
    x = r.normal(size=(400, 6)) * np.exp(spread * r.normal(size=(400, 1)) * 1.5)
    x[100:160] = x[100]
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    rows += [(900, None), (901, [1.0, None, 0.0]), (902, [float("nan")] * 6), (903, [float("inf")] * 6), (None, [1.0] * 6), (904, []), (905, [2.0])]
    vectors = norm_topk.whole_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    queries = vectors.where("vec_id % 20 = 0")
    found = defaultdict(list)
    for row in sorted(norm_topk.top_k(vectors, queries, 7).collect(), key=lambda r: (r.query_id, r["rank"])):
        found[row.query_id].append((row.vec_id, row.score))
    whole = {i: [int(np.floor(64 * v)) for v in row] for i, row in rows if i is not None and i not in (900, 901, 902, 903)}
    for q in (i for i in whole if i % 20 == 0):
        scores = [(-sum(a * b for a, b in zip(whole[q], v, strict=False)), i) for i, v in whole.items() if i != q]
        assert found[q] == [(i, -s) for s, i in sorted(scores)[:7]]
    assert norm_topk.top_k(vectors.limit(0), queries.limit(0), 7).collect() == []


PAGE = (
    "<!DOCTYPE html><html><head><title>t</title><script>var a='<p>no</p>'</script></head><body><header>Site</header>"
    "<nav><ul><li>Home<li>News</ul></nav><div class='cookie-notice'>We use cookies</div>{open}<h1>Head &amp; tail</h1>"
    "<p>One <b>bo</b>ld.<p>Two&nbsp;lines<br>here<ul><li>a</li><li>b</li></ul><div class=ad>Buy</div>{extra}<form>go</form>"
    "<p>{last}</p>{close}<aside>side</aside><section class='comments'><p>nice</p></section><footer>f</footer></body></html>"
)
LAYOUTS = [("<article>", "</article>"), ("<div id='content'>", "</div>"), ("<main>", "</main>"), ("<div>", "</div>")]


def test_wrappers_find_the_article(spark):
    rows, expected = [], {}
    for host, (open_, close) in enumerate(LAYOUTS):
        for k in range(5):
            extra = "<h2>More</h2><p>x</p>" if k % 2 else ""
            last = f"Last words of page {k}, " + "long enough to tell. " * 20
            rows.append((len(rows), f"http://h{host}.example/{k}", PAGE.format(open=open_, close=close, extra=extra, last=last)))
            expected[len(rows) - 1] = f"Head & tail One bold. Two lines here a b {'More x ' if k % 2 else ''}{last.strip()}"
    rows += [(90, None, None), (91, "odd", ""), (92, "http://h0.example/9", "<p>no article <p>here")]
    expected |= {90: "", 91: "", 92: "no article here"}
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    wrappers = page_wrappers.infer(pages)
    out = page_wrappers.extract(pages, wrappers).collect()
    assert {r.page_id: r.text for r in out} == expected
    assert all(r.n_chars == len(r.text) for r in out)
    shown = {r.host: r.expression for r in wrappers.collect()}
    assert "<h2>" in shown["h1.example"] and "</>?" in shown["h1.example"] and "</>+" in shown["h1.example"]
    empty = pages.limit(0)
    assert page_wrappers.extract(empty, page_wrappers.infer(empty)).collect() == []


def own_article(page):
    """A page's article by its own wrapper."""
    root = page_wrappers.tree(page)
    return page_wrappers.article(root, *page_wrappers.reading(page_wrappers.wrapper_of(root)))


@pytest.mark.parametrize(
    "page",
    [
        "<body><script>for(i=0;i<n;i++){f(i)}</script><article>Text here.</article><script>x</script></body>",
        "<body><SCRIPT>if(a<b)f('it')</Script ><article>Text here.</article></body>",
        "<html><head><title>t</title><meta name=a><body><article>Text here.</article></body></html>",
        "<head><title>t<meta name=a><body><article>Text here.</article>",
        "<body><div><button>Go</div><article>Text here.</article><button>Go</button></body>",
        "<body><svg><path d='M0'><article>Text <svg><svg></svg><text>no</text></svg>here.</article></body>",
        "<body><object data=x></div><article>Text <select><option>a</select>here.</article></body>",
        "<body><div><textarea>a < b</div><article>Text here.</article><style>p<a{}</style></body>",
        "<body><div><iframe src=x></div><article>Text here.<template><p>no</template></article><script>a<b",
    ],
)
def test_raw_elements_end_where_they_should(page):
    assert own_article(page) == "Text here."


LONG = "Words of the text that go on and on. " * 9


@pytest.mark.parametrize(
    "page",
    [
        "<body class='has-sidebar'><p>{}</p></body>",
        "<body class='sidebar'><div>{}</div></body>",
        "<body><div class='content no-sidebar'>{}</div><div class='site-footer__inner'>no</div></body>",
        "<body><article class='post has-comments'>{}</article></body>",
        "<body><article class='related'>{}<div class='related-posts'>no</div></article></body>",
        "<body><article><section id='related-work'>{}</section><div id='ad-728x90'>no</div></article></body>",
        "<body><div class='page-with-sidebar'><div class='promotion'>{}<p class='share-buttons'>no</p></div></div></body>",
        "<body><div class='post'>{}</div><div class='comments'><article>" + "No. " * 400 + "</article></div></body>",
    ],
)
def test_names_make_nothing_aside_that_holds_the_text(page):
    assert own_article(page.format(LONG)) == LONG.strip()


def test_names_are_overruled_by_the_wrapper(spark):
    """Also on a page where what the names stand for is short."""
    rows = [(k, f"http://h/{k}", f"<body><div class='cookie-banner'>ok?</div><div class='widget'>{prose(k, 60 if k else 1)}</div>") for k in range(4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = page_wrappers.extract(pages, page_wrappers.infer(pages)).collect()
    assert {r.page_id: r.text for r in out} == {k: prose(k, 60 if k else 1) for k in range(4)}


MENUS = {
    "lines": "".join(f"<h{i}>Constant line {i} of the menu of the site</h{i}>" for i in range(1, 7)),
    "list": "<ul>" + "".join(f"<li>Item {i} of the menu</li>" for i in range(20)) + "</ul>",
}


@pytest.mark.parametrize("menu", MENUS)
@pytest.mark.parametrize("frame", ["<div class='a'>{}</div><div class='b'>{}</div>", "<div class='main'>{}</div><div class='entry'>{}</div>"])
@pytest.mark.parametrize("many", [2, 9, 500])
def test_constants_are_no_slots_on_any_number_of_pages(menu, frame, many):
    wrapper = None
    for k in range(many):
        one = page_wrappers.wrapper_of(page_wrappers.tree(f"<body>{frame.format(MENUS[menu], f'<p>{prose(k, 40)}</p>')}</body>"))
        wrapper = one if wrapper is None else page_wrappers._merged(wrapper, one, False)
    paths, _ = page_wrappers.reading(wrapper)
    assert paths == [["html", "body", "div.entry" if "entry" in frame else "div.b"]]


def test_scarce_slots_do_not_hide_the_text():
    """Two pages that differ in a date only."""
    pages = [page_wrappers.tree(f"<body><div class='a'><p>{LONG}</p></div><div class='b'>Day {k}</div></body>") for k in range(2)]
    paths, _ = page_wrappers.reading(page_wrappers._merged(*map(page_wrappers.wrapper_of, pages), False))
    assert LONG.strip() in page_wrappers.article(pages[0], paths)


def _fits(host, path, rule_host, rule_path):
    return (host == rule_host or host.endswith("." + rule_host)) and path.startswith(rule_path)


def test_url_rules_against_every_rule(spark):
    r = random.Random(8)
    hosts = ["org", "example.org", "a.example.org", "b.a.example.org", "anexample.org", "com", "x.com", "example.org.", ""]
    paths = ["/", "/es/", "/es/x", "/en/1", "/en/12/3", "/e", ""]
    rules = [(h, p, r.choice(["allow", "block"])) for h, p in itertools.product(hosts[:6], paths[:5]) if r.random() < 0.5]
    urls = [f"http://{h.upper() if i % 2 else h}{p}?q#f" for i, (h, p) in enumerate(itertools.product(hosts, paths))]
    urls += [None, "", "no scheme/x", "a://spam-farm.test/x", "http://h\n.org/y\nz"] + ["http://x.com/es/"] * 300
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    table = spark.createDataFrame(rules, url_rules.RULES)
    out = {row.page_id: row for row in url_rules.judge(pages, table).collect()}
    for i, url in enumerate(urls):
        m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        fits = [(len(h), len(p), h + p, v) for h, p, v in rules if _fits(host, path, h, p)]
        rule, verdict = max(fits)[2:] if fits else (None, "block" if host in ("", "spam-farm.test") else "allow")
        assert (out[i].host, out[i].path, out[i].rule, out[i].verdict) == (host, path, rule, verdict), url
    assert url_rules.judge(pages.limit(0), table).collect() == []
    assert {row.rule for row in url_rules.judge(pages, table.limit(0)).collect()} == {None}


def plain_components(texts):
    def shingles(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i : i + 5]) for i in range(len(w) - 4)])

    sets, head = [shingles(t) for t in texts], list(range(len(texts)))

    def top(i):
        while head[i] != i:
            i = head[i]
        return i

    for i, j in itertools.combinations(range(len(texts)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
            a, b = top(i), top(j)
            head[max(a, b)] = min(a, b)
    return [(len(s), top(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize("node_rows", [300, 8])
def test_components_of_near_copies(spark, monkeypatch, node_rows):
    """With few rows a node, groups are too large for their nodes and are settled in blocks."""
    monkeypatch.setattr(chosen_path, "NODE_ROWS", node_rows)
    monkeypatch.setattr(chosen_path, "MAX_DEPTH", 2)
    r = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(4):
        base = [r.choice(vocabulary) for _ in range(120)]
        for _ in range(25):
            copy = list(base)
            for _ in range(r.randint(0, 4)):
                copy[r.randrange(len(copy))] = r.choice(vocabulary)
            texts.append(" ".join(copy))
    texts += ["", "a b", None, "A  b", "a b c", "x " * 30, " \n"] * 2
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    out = {row.doc_id: row for row in chosen_path.link(docs).collect()}
    assert [(out[i].n_shingles, out[i].component_id) for i in range(len(texts))] == plain_components(texts)
    assert all(row.kept == (row.doc_id == row.component_id) for row in out.values())


def test_long_texts_are_shingled_in_slices():
    text = prose(1, 300_000)
    shingler = chosen_path.Shingler()
    words = shingler.words(text)
    assert len(text) > 1 << 20 and len(words) == 300_000
    tail = " ".join(text.split()[-50:])
    assert (shingler.words(tail) == words[-50:]).all()


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m[0] if c.isdigit()]
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card":
                check = sum(sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(reversed(digits)))
                if not 14 <= len(digits) <= 19 or check % 10:
                    continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(out)]


def test_base_spans_against_the_patterns():
    r = random.Random(4)
    bits = ["a@b.c", "@", ".", "x-y@", "10.2.3.4", "300.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1111", "+1 (017) 555-7713",
            "+", " ", "é😀", "1", "00000000000000", "-", "@d.e.f@g.h", "%", "(", "5555555555554444", "\n", "_"]
    for _ in range(4000):
        text = "".join(r.choice(bits) for _ in range(r.randint(1, 14)))
        assert [f"{k}:{a}:{b}" for a, b, k in personal_data.base_spans(text)] == plain_spans(text), text


def test_weak_labels_train_a_classifier(spark):
    """On planted spans: what is added is personal data, and lookalikes are left alone."""
    r, rows, good, bad = random.Random(6), [], set(), set()
    for i in range(300):
        digits = f"{r.randint(200, 899)}-{r.randint(200, 999)}-{r.randint(1000, 9999)}"
        secret = "".join(r.choice("0123456789abcdef") for _ in range(40))
        kind = i % 4
        text = prose(i, 12) + " " + {
            0: f"call {digits} now", 1: f'token = "{secret}" ok', 2: f"write to jo{i} [at] mail.example [dot] com or", 3: f"order serial x= {'abcdefgh' * 3}/path/of/file y",
        }[kind] + f" and my.name{i}@mail.example.com too"
        rows.append((i, text, "", "", 0))
        start = text.index({0: digits, 1: secret, 2: f"jo{i} [", 3: "abcdefgh"}[kind])
        (bad if kind == 3 else good).add((i, start))
    rows += [(900, None, "", "", 0), (901, "", "", "", 0)]
    out = {row.doc_id: row.spans for row in personal_data.find(spark.createDataFrame(rows, DOCS)).collect()}
    added = {(i, s.start) for i, spans in out.items() for s in spans if not s.base}
    assert len(good - added) <= 0.05 * len(good) and not bad & added
    assert sum(s.kind == "email" and s.base for spans in out.values() for s in spans) == 300
    assert out[900] == out[901] == []
    assert personal_data.find(spark.createDataFrame([], DOCS)).collect() == []
