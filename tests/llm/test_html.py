"""Blocks in table cells: cells hold the lines that their content has by itself."""

import random

import pytest

from rxtrail.llm import html


def blocks(pick: random.Random, depth: int) -> str:
    """Some blocks: paragraphs, lists, preformatted text, quotes, tables of one cell."""
    word = lambda: pick.choice(["ab", "c", "défi", "x1", "&lt;"])
    line = lambda: " ".join(word() for _ in range(pick.randrange(1, 5)))
    made = []
    for _ in range(pick.randrange(1, 4)):
        kind = pick.randrange(6 if depth else 4)
        if kind == 0:
            made.append(f"<p>{line()}<br>{line()}</p>")
        elif kind == 1:
            made.append(f"<pre>{line()}\n   {line()}\n\n {line()}</pre>")
        elif kind in (2, 3):
            made.append(f"<div>{line()} <b>{word()}</b></div>")
        elif kind == 4:
            made.append("<ul>" + "".join(f"<li>{blocks(pick, depth - 1)}" for _ in range(2)) + "</ul>")
        else:
            made.append(f"<blockquote>{blocks(pick, depth - 1)}</blockquote>")
    return "".join(made)


@pytest.mark.parametrize("seed", range(60))
def test_cells_keep_the_lines_of_their_blocks(seed):
    """Random cells, held line by line against what each gives as a page of its own."""
    pick = random.Random(seed)
    n = pick.randrange(1, 4)
    rows = [[blocks(pick, 2) for _ in range(n)] for _ in range(pick.randrange(1, 4))]
    alone = [[html.render(cell).split("\n") for cell in row] for row in rows]
    found = html.render("<table>" + "".join("<tr>" + "".join(f"<td>{cell}</td>" for cell in row) for row in rows) + "</table>")
    widths = [max(len(line) for row in alone for line in row[c]) for c in range(n)]
    assert max(widths) <= html.WIDEST
    lines = iter(found.split("\n"))
    for row in alone:
        for i in range(max(map(len, row))):
            wanted = "  ".join((cell[i] if i < len(cell) else "").ljust(w) for cell, w in zip(row, widths, strict=True))
            assert next(lines) == wanted.rstrip()
    assert next(lines, None) is None


def test_layout_tables_read_like_blocks():
    inside = "<p>a<p>b<ul><li>x<li>y</ul>" + "<p>" + "word " * 30
    assert html.render(f"<table><tr><td>{inside}</table>") == html.render(f"<div>{inside}</div>")
    nested = "<table><tr><td>1<td>2<tr><td>33<td>4</table>"
    assert html.render(f"<table><tr><td>{nested}</table>") == "1   2\n33  4"
    assert html.render(f"<table><tr><td>L<td>{nested}<tr><td>l2<td>q</table>") == "L   1   2\n    33  4\nl2  q"
    assert html.render(f"<table><tr><td>{nested}<td>R<tr><td>q<td>r</table>") == "1   2  R\n33  4\nq      r"


def test_long_lines_in_cells_keep_their_indentation():
    words = " ".join(["word"] * 12)
    found = html.render(f"<table><tr><td><blockquote>{words}</blockquote><td>b</table>").split("\n")
    assert found == ["  " + " ".join(["word"] * 7) + "  b", "  " + " ".join(["word"] * 5)]
    blank = html.render("<table><tr><td><p>a<p>&nbsp;<td>b<tr><td><td></table>")
    assert blank == "a  b"
    deep = "<table><tr><td>" * 400 + "x<p>y"
    assert html.render(deep) == "x\n\ny"
