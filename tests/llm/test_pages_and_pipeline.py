"""HTML extraction, the pipeline, and the contracts of the registered queries."""

from __future__ import annotations

import html as references
import re
import time
from collections import Counter

import pytest

import corpus_pipeline
from tablewright.llm import sharding, suite, wrappers

SMALL, FOLDER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="<p>no</p>";</script></head>
<body><div class="site-header"><a href="/">Site name</a></div><div class="menu"><ul><li>Home<li>About</ul></div>
<div id="wrap"><div class="col"><div class="entry"><h1>{title}</h1><span>Filed under news</span><p>{first}<br>second  line
<p>{side}: fish &amp; chips &lt;b&gt; caf&eacute;&nbsp;bar<div class="ads">Buy now</div><ul><li>one {side}<li>two {title}</ul>
<!-- gone --><blockquote>said <i>{title}</i></blockquote></div></div>
<div class="sidebar"><p>{side} and a lot of words that are not part of it at all, however many there may be</p></div></div>
<form><label>Mail</label><input value="x"></form><div class="comments"><p>{first} is nonsense, says a reader</p></div>
<footer>&copy; all</footer></body></html>"""


def page(n):
    return PAGE.format(title=f"Title {n}", first=f"Body number {n} has enough words to be the main part of it.", side=f"Side {n}")


def expected(n):
    return "\n\n".join(
        [f"Title {n}", f"Body number {n} has enough words to be the main part of it. second line", f"Side {n}: fish & chips <b> café bar",
         f"one Side {n}", f"two Title {n}", f"said Title {n}"]
    )


def brute_force(pages, share=0.9, least=3, most=0.3):
    """Host to the wrapper's fixed (element, text) pairs and menus, one page after the other."""
    seen = {}
    for url, body in pages:
        host = re.match(r"(?:[a-z][a-z0-9+.-]*://([^/:?#]*))?", (url or "").lower())[1]
        found = wrappers.blocks(body)
        if host and found:
            longest = max((b.text for b in found), key=lambda text: (len(text), text))
            seen.setdefault(host, {})[longest] = found
    result = {}
    for host, different in seen.items():
        having, holding, size, links, repeated = Counter(), Counter(), Counter(), Counter(), set()
        for found in different.values():
            having.update({b.path for b in found})
            holding.update({(b.path, b.text) for b in found})
            repeated |= {path for path, times in Counter(b.path for b in found).items() if times > 1}
            for b in found:
                size[b.path] += len(b.text)
                links[b.path] += len(b.text) if b.links and not b.marked else 0
        fixed = {k for k, n in holding.items() if n >= least and n >= share * having[k[0]]}
        if sum(len(text) * holding[path, text] for path, text in fixed) > most * sum(size.values()):
            fixed = set()
        menus = {p for p in repeated if having[p] >= least and links[p] >= 0.8 * size[p]}
        result[host] = fixed, menus
    return result


def extracted(spark, pages):
    """Texts by the wrappers of these (url, html) pages, in order; equal to brute force."""
    rows = [(n, url, body) for n, (url, body) in enumerate(pages)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    found = {r["page_id"]: r["text"] for r in wrappers.extract_pages(table, wrappers.infer_wrappers(table)).collect()}
    plain = brute_force(pages)
    for n, url, body in rows:
        host = re.match(r"(?:[a-z][a-z0-9+.-]*://([^/:?#]*))?", (url or "").lower())[1]
        fixed, menus = plain.get(host, (set(), set()))
        kept = [b for b in wrappers.blocks(body) if (b.path, b.text) not in fixed and not (b.links and not b.marked and b.path in menus)]
        assert found[n] == "\n\n".join(b.text for b in kept)
    return [found[n] for n in range(len(rows))]


def words_of(n, count):
    return " ".join(f"w{n}x{k * k % 97}" for k in range(count))


def test_wrapper_finds_the_article_without_marked_elements(spark):
    assert extracted(spark, [(f"http://a.example/{n}", page(n)) for n in range(6)]) == [expected(n) for n in range(6)]
    # Without the host's other pages the fixed line cannot be told from the article.
    assert "Filed under news" in wrappers.extract(page(9))


def test_layouts_that_only_the_other_pages_of_the_host_explain(spark):
    """A split body, notices in plain paragraphs, a layout on few pages, lists of links."""
    links = "<div>" + "".join(f"<div><a href=/{k}>Section {k} of site</a></div>" for k in range(5)) + "</div>"
    pages, texts = [], []
    for n in range(60):
        head = f"<div class=top><h1>Title {n}</h1><p>Lead {n} {words_of(n, 5)}</p></div>"
        body = f"<div class=main-text><p>{words_of(n, 40)}</p><p>{words_of(n + 100, 30)}</p></div><div class=second><p>{words_of(n + 200, 12)}</p></div>"
        rare = "<div class=special><p>Special report, all parts here</p></div>" if n % 20 == 0 else ""
        varying = "".join(f"<section><a href=/{k}>See {n} {k}</a></section>" for k in range(3))
        pages.append(("http://b.example/x", f"<body>{links}{head}{rare}<p>This notice is on all pages.</p>{body}{varying}</body>"))
        texts.append("\n\n".join([f"Title {n}", f"Lead {n} {words_of(n, 5)}", words_of(n, 40), words_of(n + 100, 30), words_of(n + 200, 12)]))
    assert extracted(spark, pages) == texts
    assert all(wrappers.extract(body) != text for (_, body), text in zip(pages, texts))


def test_notice_inside_a_marked_article_goes_and_a_shared_passage_stays(spark):
    notice, passage = "<p>Read our terms first.</p>", "A passage that two of the pages share."
    pages = [
        ("http://c.example/", f"<article><h1>T{n}</h1>{notice}<p>{words_of(n, 20)}</p>{f'<p>{passage}</p>' if n < 2 else ''}</article>")
        for n in range(10)
    ]
    assert extracted(spark, pages) == ["\n\n".join([f"T{n}", words_of(n, 20)] + [passage] * (n < 2)) for n in range(10)]


def test_copies_of_a_page_are_no_template(spark):
    copy = "<nav>{}</nav><article><h1>Same title</h1><p>" + words_of(1, 30) + "</p></article>"
    near = "<article><h1>Same title</h1><p>" + words_of(1, 30) + " {}</p><p>" + words_of(2, 25) + "</p></article>"
    pages = [("http://d.example/", copy.format(n)) for n in range(20)] + [("http://e.example/", near.format(n)) for n in range(20)]
    texts = extracted(spark, pages)
    assert texts[:20] == ["Same title\n\n" + words_of(1, 30)] * 20
    assert texts[20:] == [f"Same title\n\n{words_of(1, 30)} {n}\n\n{words_of(2, 25)}" for n in range(20)]


@pytest.mark.parametrize(
    "markup",
    ['<a href="' * 100_000, "<b " * 100_000, "<div>" * 100_000 + "end", '<a ">"' * 50_000, "<p><table>" + "<b><div>" * 50_000,
     "<div>" * 50_000 + "</span>" * 50_000, "<!--" * 100_000, "<script>" * 50_000, "<" * 200_000, "<li>" * 100_000, "</" * 100_000],
)
def test_broken_markup_costs_linear_time(markup):
    begun = time.process_time()
    wrappers.extract(f"<p>first</p>{markup}")
    assert time.process_time() - begun < 20


def test_general_rules_without_a_wrapper():
    assert wrappers.extract(None) == wrappers.extract("") == wrappers.extract("<nav>menu</nav>") == ""
    assert wrappers.extract("plain <b>text</b>\n only") == "plain text only"
    text = "<nav>x</nav><article><header>Top</header><h1>A</h1><p>b<p>c<aside>d</aside></article><p>after"
    assert wrappers.extract(text) == "Top\n\nA\n\nb\n\nc"
    assert wrappers.extract("<p>1 < 2 & 3 &#x41; <script>x</p>") == "1 < 2 & 3 A"
    assert wrappers.extract("<div hidden>no</div><table><tr><td>a<td>b<tr><td>c</table>") == "a b\n\nc"


    assert wrappers.extract('<div class="article share"><p>x</p></div>') == "x"
    assert wrappers.extract('<div class="comments content"><p>x</p></div><div class="share">y</div>z') == "z"


def test_alignment_makes_slots_optional_and_repeated_groups(spark):
    bodies = ["<div><h1>a</h1><p>x</p><p>y</p></div>", "<div><h1>b</h1><section>z</section><p>x</p></div>", "<div><h1>c</h1><p>x</p><p>long text</p></div>"]
    table = spark.createDataFrame([("http://h/", body) for body in bodies * 2], "url string, html string")
    rows = {r["key"]: r for r in wrappers.infer_wrappers(table).collect()}
    assert {k: (r["pages"], r["of"], r["optional"], r["repeated"], r["slot"], len(r["fixed"])) for k, r in rows.items()} == {
        "h1": (3, 3, False, False, True, 0), "section": (1, 3, True, False, True, 0), "p": (3, 3, False, True, True, 1),
    }


def test_pages_of_many_kinds(spark):
    rows = [(n, f"http://one.example.org/{n}", page(n)) for n in range(12)] + [(3, "http://one.example.org/3", page(3))]
    rows += [
        (50, None, page(1)), (51, "http://two.example.org/", None), (52, "http://two.example.org/", ""), (None, "no address", "<p>x"),
        (53, "HTTP://One.example.org:80/x", "<p>other layout</p>"), (54, "http://three.example.org", "<p>" + "long " * 50_000 + "</p>"),
    ]
    table = spark.createDataFrame([(*row, "old") for row in rows], "page_id long, url string, html string, text string")
    found = wrappers.extract_pages(table, wrappers.infer_wrappers(table)).collect()
    assert len(found) == len(rows)
    texts = {row["page_id"]: row["text"] for row in found}
    assert all(texts[n] == expected(n) for n in range(12))
    assert texts[51] == texts[52] == "" and texts[None] == "x" and texts[53] == "other layout"
    assert len(texts[54]) == 249_999
    assert all(row["n_chars"] == len(row["text"]) for row in found)
    nothing = table.limit(0)
    assert wrappers.extract_pages(nothing, wrappers.infer_wrappers(nothing)).count() == 0


def test_pages_of_the_table_against_their_known_layout(spark):
    """The given pages keep their article in one element, in headings and paragraphs."""
    raw = {row["page_id"]: row["html"] for row in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    found = suite.op2_wrappers(spark, FOLDER).collect()
    assert len(found) == len(raw)
    for row in found:
        body = re.search(r"<article>(.*)</article>", raw[row["page_id"]], re.DOTALL)[1]
        blocks = [re.sub(r"<[^>]*>", " " , part) for part in re.split(r"</?(?:h1|p)>", body.replace("<b>", "").replace("</b>", ""))]
        blocks = [" ".join(references.unescape(block).split()) for block in blocks]
        assert row["text"] == "\n\n".join(block for block in blocks if block)


def test_pipeline_stages_against_plain_checks(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before, columns = docs, docs.columns
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, FOLDER).cache()
        kept.append(after.count())
        if name != "sharding":
            assert after.columns == columns
            assert set(row["doc_id"] for row in after.select("doc_id").collect()) <= set(
                row["doc_id"] for row in before.select("doc_id").collect()
            )
        else:
            assert Counter(after.select(columns).collect()) == Counter(before.collect())
        if name == "near-duplicates":
            assert after.select("text").distinct().count() == kept[-1]
        if name == "benchmark decontamination":
            texts = [row["text"] for row in after.collect()]
            items = [row["text"] for row in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
            assert not any(item in text for text in texts for item in items)
        before = after
    assert docs.count() > kept[0] > kept[1] > kept[2] and kept[4] == kept[3]


def test_pipeline_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    assert docs.count() == 0


def test_stages_keep_columns_named_like_their_own(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, target string, taken string, position string, size string"
    rows = [(n, words_of(n, 60 + n), "en", ("a", None)[n % 2], n, f"t{n}", f"k{n}", None, f"s{n}") for n in range(30)]
    rows += [rows[0], (None, words_of(99, 70), None, None, None, None, None, "p", None), (98, None, None, "a", 1, "t", "k", "p", "s"), (97, "", "en", "a", 1, "t", "k", "p", "s")]
    docs = spark.createDataFrame(rows, schema)
    mixed = corpus_pipeline.mix(spark, docs, SMALL)
    assert mixed.dtypes == docs.dtypes
    assert {tuple(row) for row in mixed.collect()} <= set(rows)
    for _, stage in corpus_pipeline.STAGES[:3]:
        assert stage(spark, docs, SMALL).dtypes == docs.dtypes


def test_shards_do_not_depend_on_input_order(spark):
    """Rows that share key and text but differ elsewhere keep their slots."""
    rows = [(7, "same text", f"source {n}") for n in range(50)] + [(None, None, f"source {n}") for n in range(20)]
    found = [
        {row["source"]: (row["shard"], row["slot"]) for row in sharding.shard(spark.createDataFrame(given, "doc_id long, text string, source string"), 4).filter("text is not null").collect()}
        for given in (rows, rows[::-1])
    ]
    assert found[0] == found[1] and len(found[0]) == 50


COLUMNS = {
    "op1_near_duplicates": {"doc_id": "bigint", "class_id": "bigint"},
    "op2_wrappers": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op3_quality_trees": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op4_language": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op5_decontamination": {"doc_id": "bigint", "item_id": "bigint"},
    "op6_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op7_mixing": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op8_quality_rules": {
        "doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint",
        "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean",
    },
    "op9_sharding": {
        "doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint",
        "grown_shard": "int",
    },
    "op10_token_files": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op11_phrases": {
        "lang": "string", "rank": "bigint", "phrase": "string", "a": "bigint", "l": "bigint", "r": "bigint", "n": "bigint",
        "score": "bigint",
    },
    "op12_bpe_trie": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op13_conversation_trie": {
        "conv_id": "bigint", "depth": "bigint", "parent_conv_id": "bigint", "n_convs": "bigint", "n_children": "bigint",
        "n_leaves": "bigint", "saved_tokens": "bigint", "ends_sha256": "string",
    },
}


@pytest.mark.parametrize("name", sorted(suite.QUERIES))
def test_columns_and_rows_of_the_queries(spark, name):
    found = suite.QUERIES[name](spark, SMALL)
    assert COLUMNS[name].items() <= dict(found.dtypes).items()
    table = "pages" if name == "op2_wrappers" else "documents"
    if name not in ("op5_decontamination", "op11_phrases", "op13_conversation_trie"):
        assert found.count() == spark.read.parquet(f"{SMALL}/{table}.parquet").count()
