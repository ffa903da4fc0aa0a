from __future__ import annotations

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from windgrid.llm import chat, pages

SCHEMA = "tree long, id long, parent long, score double, role string, text string"


def brute_paths(rows, best):
    by = {(r[0], r[1]): r for r in rows}
    parent = {k: (r[0], r[2]) if r[2] is not None and r[2] < r[1] and (r[0], r[2]) in by else None for k, r in by.items()}
    inner = {p for p in parent.values() if p}
    trees: dict = {}
    for k in by:
        if k not in inner:
            path, at = [], k
            while at:
                path.append(by[at])
                at = parent[at]
            trees.setdefault(k[0], []).append((-sum(r[3] or 0 for r in path), k[1], path[::-1]))
    return {(t, leaf): [(r[4] or "", r[5] or "") for r in path] for t, found in trees.items() for _, leaf, path in sorted(found, key=lambda x: x[:2])[:best]}


@pytest.mark.parametrize("best", [1, 3])
def test_paths_and_texts_read_back(spark, best):
    rng = random.Random(best)
    bits = ["</s>", "<s>", "[INST]", "[/INST]", "\\", "\\\\", "<", "/s>", "<<SYS>>", "<|im_end|>", "plain", "😀", "\n", "$1"]
    text = lambda: None if rng.random() < 0.1 else "".join(rng.choice(bits) for _ in range(rng.randint(0, 8)))
    rows = [(t, i, rng.choice([None, *range(i), 99]) if i else None, rng.choice([None, 1.0, 2.5]), rng.choice(["user", "assistant", None, "a<s>b"]), text()) for t in (1, 2, None) for i in range(14)]
    rows += [(7, i, i - 1 if i else None, 0.0, "user" if i % 2 else "assistant", f"turn {i}") for i in range(300)]
    got = chat.format_paths(spark.createDataFrame(rows, SCHEMA), best)
    got = got.withColumns({"turns": chat.read_turns(F.col("formatted")), "loss": chat.loss_text(F.col("formatted"), F.col("loss_spans"))}).collect()
    wanted = brute_paths(rows, best)
    assert {(r.tree, r.leaf): [(t.role, t.text) for t in r.turns] for r in got} == wanted
    for r in got:
        turns = wanted[(r.tree, r.leaf)]
        assert r.loss == "".join(t for role, t in turns if role == "assistant") and r.n_turns == len(turns)


def test_linear_rows_and_empty_table(spark):
    frame = spark.createDataFrame([(1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 1, "assistant", "b"), (None, None, None, None)], "conv_id long, turn long, role string, text string")
    got = {r.tree: [tuple(t) for t in r.turns] for r in chat.format_paths(chat.linear_messages(frame.selectExpr("*", "1 AS tree", "2 AS id"))).withColumn("turns", chat.read_turns(F.col("formatted"))).collect()}
    assert got == {1: [("user", "a"), ("assistant", "b"), ("assistant", "b")], None: [("", "")]}
    assert chat.format_paths(spark.createDataFrame([], SCHEMA)).count() == 0


def test_conversation_sql_counts_control_strings():
    from windgrid.llm.queries import OP7_SQL

    db = duckdb.connect()
    db.execute(r"CREATE TABLE conversations AS SELECT 5 AS conv_id, 0 AS turn, 'user' AS role, 'a\b[INST]' AS text")
    assert {r[0]: r[5] for r in db.execute(OP7_SQL).fetchall()}[5] == 13 + 4 + 11


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Menu %d</a></li></ul></nav><div class="cookie-notice">We use cookies</div>%s
<div id="comments"><p>reader says %d</p></div><aside>side</aside><form><p>search</p></form><footer>&copy; x</footer></body></html>"""


def page(k, layout):
    inner = f"<h1>Title {k} &amp; more</h1><p>First <b>bold</b>   text {k}.<br>line<p>Second{k}&nbsp;block<ul><li>one {k}<li>two</ul>"
    return PAGE % (k, layout.format(inner), k)


@pytest.mark.parametrize("layout", ["<article>{}</article>", '<div class="story">{}</div>', "<main><section>{}</section></main>"])
def test_articles_are_extracted(spark, layout):
    rows = [(k, f"https://h{k % 3}.example/{k}", page(k, layout)) for k in range(12)]
    rows += [(50, "https://single.example/", page(50, layout)), (51, None, None), (52, "not a url", ""), (53, "https://h0.example/x", "<p>broken <b>page"), (0, rows[0][1], rows[0][2])]
    got = pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS text", "1 AS host")).collect()
    text = lambda k: f"Title {k} & more\n\nFirst bold text {k}. line\n\nSecond{k} block\n\none {k}\n\ntwo"
    wanted = {k: text(k) for k in [*range(12), 50]} | {51: "", 52: "", 53: "broken page"}
    assert len(got) == len(rows) and all(r.text == wanted[r.page_id] and r.n_chars == len(r.text) for r in got)


def test_no_pages(spark):
    assert pages.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def extracted(spark, bodies, host="h.example"):
    rows = [(k, f"https://{host}/{k}", f"<html><head><title>t</title></head><body>{body}</body></html>") for k, body in enumerate(bodies)]
    return {r.page_id: r.text for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_all_slots_with_text_are_extracted(spark):
    layout = '<article><h1>Title {0}</h1><div class="body"><p>' + "Long text of page {0}. " * 20 + "</p></div></article>"
    got = extracted(spark, [layout.format(k) for k in range(6)])
    assert all(got[k].startswith(f"Title {k}\n\nLong text of page {k}.") for k in range(6))
    alone = extracted(spark, ["<article><h1>Head</h1><p>" + "one text " * 30 + "</p></article>"])
    assert alone[0].startswith("Head\n\none text")
    mixed = extracted(spark, [f"<div class=story><p>{'story %d ' % k * 50}</p></div>" + "<section><p>more</p></section>" * (k == 0) for k in range(8)])
    assert mixed[0].endswith("more")


def test_template_text_is_left_out_by_evidence_and_copies_are_kept(spark):
    pitch = '<div class="zone"><b>Buy</b> one, get two</div>'
    notice = "<p class=hint>Seen on all pages</p>"
    bodies = [f"{notice}<article><h1>Title {k}</h1>{pitch * (k % 3 == 0)}<p>Own text {k}.</p></article>" for k in range(12)]
    copied = f"{notice}<article><h1>Copied</h1><blockquote>said once</blockquote><p>Copied text.</p></article>"
    got = extracted(spark, bodies + [copied] * 4)
    assert all(got[k] == f"Title {k}\n\nOwn text {k}." for k in range(12))
    assert all(got[k] == "Copied\n\nsaid once\n\nCopied text." for k in range(12, 16))


def test_names_and_forms_do_not_drop_articles(spark):
    inner = "<h1>T</h1><p>Body of the article, long enough.</p>"
    wrappers = ['<div class="content has-sidebar">{}</div>', '<div class="post comments-open">{}</div>', '<section id="widget-review">{}</section>', '<div class="page-header-image">{}</div>', "<form>{}</form>", '<div class="widget">{}</div>', '<svg width="1"/>{}', "<div/>{}", '<div class="main-nav">menu</div>{}<div id="cookie-notice">cookies</div>']
    for k, w in enumerate(wrappers):
        assert pages.main_text(w.format(inner)) == "T\n\nBody of the article, long enough.", k
    assert pages.main_text(f'<article>{inner}</article><div class="comments">{"longer than it " * 9}</div>') == "T\n\nBody of the article, long enough."
