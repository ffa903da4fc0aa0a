"""Templates of hosts: what stays of an article, and the same deduction in plain Python."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import pytest

from windgrid.llm import pages


def extracted(spark, htmls, host="h.example"):
    frame = spark.createDataFrame([(k, f"https://{host}/{k}", h) for k, h in enumerate(htmls)], "page_id long, url string, html string")
    return {r.page_id: r.text for r in pages.extract(frame).collect()}


def test_constant_headings_and_bylines_stay(spark):
    html = [
        f"<body><div class='top'>Our site</div><article><h1>Recipe {k}</h1><div class='by'>By the team</div><h2>Ingredients</h2><p>flour {k}</p><h2>Method</h2><p>bake {k} times</p></article><div class='low'>All rights</div></body>"
        for k in range(12)
    ]
    got = extracted(spark, html)
    assert got[3] == "Recipe 3\n\nBy the team\n\nIngredients\n\nflour 3\n\nMethod\n\nbake 3 times"
    no_tag = [h.replace("article", "section") for h in html]
    assert extracted(spark, no_tag) == got


@pytest.mark.parametrize("n", [40, 290, 310])
def test_an_interruption_on_three_pages_goes_at_any_size(spark, n):
    html = [f"<body><article><h1>Title {k}</h1><p>text {k} of it</p>{'<div>Buy now</div>' if k < 3 else ''}<p>more {k}</p></article></body>" for k in range(n)]
    got = extracted(spark, html)
    assert all(got[k] == f"Title {k}\n\ntext {k} of it\n\nmore {k}" for k in range(n))


def test_pages_of_the_template_alone_are_empty_and_equal_pages_stay(spark):
    html = [f"<body><div class='top'>Our site</div><article><p>text {k}</p></article></body>" for k in range(9)] + ["<body><div class='top'>Our site</div><article></article></body>"]
    assert extracted(spark, html)[9] == ""
    assert set(extracted(spark, ["<body><div>Same</div><p>on all</p></body>"] * 5).values()) == {"Same\n\non all"}


def test_a_very_long_page(spark):
    html = ["<body><article>" + f"<p>{'word ' * 20}{k}</p>" * 20_000 + "</article></body>" for k in range(3)]
    assert [len(t) for t in extracted(spark, html).values()] == [len("\n\n".join([f"{'word ' * 20}{k}"] * 20_000)) for k in range(3)]


def plain_templates(by_page):
    """The deduction over one host, from lists of (path, text or None)."""
    n, elements, nodes = len(by_page), defaultdict(set), defaultdict(dict)
    for k, found in enumerate(by_page):
        for path, text in found:
            if text is None:
                elements[path].add(k)
            else:
                nodes[path, text][k] = nodes[path, text].get(k, 0) + 1
    around = {p: len(v) for p, v in elements.items()}
    slot = {p: min(len(v) for (q, _), v in nodes.items() if q == p) < 0.9 * around[p] for p in {p for p, _ in nodes} if p in around}
    mass = defaultdict(int)
    for (p, t), v in nodes.items():
        if slot.get(p):
            steps = p.split("/")
            for k in range(1, len(steps)):
                mass["/".join(steps[:k])] += len(v) * len(t)
    if not mass:
        return set()
    body = max((b.count("/") + 1, m, b) for b, m in mass.items() if 2 * m >= mass[""])
    body = None if re.fullmatch(r"(/(html|body)(\.[a-z]+)?)*", body[2]) else body[2]
    classes = defaultdict(list)
    for (p, t), v in nodes.items():
        if len(v) >= 3 and p in slot:
            classes[frozenset(v.items())].append((p, t))
    out = set()
    for members in classes.values():
        on = len(nodes[members[0]])
        if any(slot[p] for p, _ in members) and on < 0.9 * n:
            continue
        for p, t in members:
            inside = bool(re.search(r"/(article|main)(\.[a-z]+)?(/|$)", p)) or (body is not None and f"{p}/".startswith(f"{body}/"))
            interrupts = 2 * on < n and not re.search(r"/(h[1-6]|p|li|dt|dd|td|th|pre|blockquote|figcaption|article|main)(\.[a-z]+)?$", p)
            if not slot[p] and (not inside or interrupts):
                out.add((p, t))
    return out


def test_templates_equal_plain_deduction(spark):
    rng = random.Random(8)
    hosts = {}
    for h in range(12):
        wrap = rng.choice(["article", "div class='content'", "section", "main"])
        fixed = [f"<div class='c{j}'>fixed {j}</div>" for j in range(rng.randint(0, 4))]
        made = []
        for k in range(rng.randint(1, 14)):
            inner = "".join(rng.choice([f"<p>{'free ' * rng.randint(1, 9)}{k}</p>", "<h2>Head</h2>", "<div class='x'>Buy</div>", f"<p>copy {rng.randint(0, 2)}</p>"]) for _ in range(rng.randint(0, 6)))
            made.append(f"<html><body>{''.join(f for f in fixed if rng.random() < 0.9)}<div><{wrap}>{inner}</{wrap.split()[0]}></div><p>Imprint</p></body></html>")
        hosts[f"h{h}.example"] = made
    rows = [(1000 * i + k, f"https://{h}/{k}", p) for i, (h, made) in enumerate(hosts.items()) for k, p in enumerate(made)]
    got = {r.page_id: r.text for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i, made in enumerate(hosts.values()):
        found = [pages.blocks(p) for p in made]
        template = plain_templates([[*f, ("", None)] for f in found])
        for k, f in enumerate(found):
            assert got[1000 * i + k] == "\n\n".join(t for p, t in f if t is not None and (p, t) not in template), (i, k)
