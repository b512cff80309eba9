"""Containers below long paths stay apart."""

from tidemark.llm.html import LONGEST_PATH, extract, parse

LONG = "A sentence with quite a few words in it, so that it counts as a paragraph of the article. "
CLASSES = " ".join(f"utility-{a}{b}" for a in "abcde" for b in "vwxyz")


def page(text):
    side = f"<div class='{CLASSES} two'><p>{LONG}</p></div>"
    return f"<body>{f'<div class=\"{CLASSES}\">' * 6}<div class='{CLASSES} wrap'><div class='{CLASSES} one'><p>{text}</p><p>{text}</p></div>{side}</div></body>"


def test_side_column_below_a_long_path():
    nodes = parse(page(LONG * 5))[1]
    paths = [n.path for n in nodes]
    assert len(set(paths)) == len(paths) == 10 and max(map(len, paths)) <= LONGEST_PATH


def test_winning_path_below_a_long_path():
    usual = parse(page(LONG * 5))[1][8].path
    assert extract(page(LONG * 3), {usual}) == "\n\n".join([(LONG * 3).strip()] * 2)
    assert [n.path for n in parse(page("x"))[1]] == [n.path for n in parse(page(LONG))[1]]
