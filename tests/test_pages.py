"""Filter panels by places of tags against a tree of the whole page."""

import random
from html.parser import HTMLParser

from lotwise import fixed_values as fx
from lotwise.sources.pages import extract_panels

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
class _Node:
    __slots__ = ("tag", "attrs", "classes", "children", "parent")

    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.parent = tag, dict(attrs), parent
        self.classes = set((self.attrs.get("class") or "").split())
        self.children = []

    def find_all(self, test):
        """Matching descendants in document order, without recursion."""
        stack = [c for c in reversed(self.children) if isinstance(c, _Node)]
        while stack:
            node = stack.pop()
            if test(node):
                yield node
            stack.extend(c for c in reversed(node.children) if isinstance(c, _Node))

    def first(self, cls, tag=None):
        return next(self.find_all(lambda n: cls in n.classes and tag in (None, n.tag)), None)

    def text(self):
        parts, stack = [], list(reversed(self.children))
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                parts.append(node)
            elif node.tag not in ("script", "style"):
                stack.extend(reversed(node.children))
        return " ".join("".join(parts).split())


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = _Node("", [], None)

    def handle_starttag(self, tag, attrs):
        node = _Node(tag, attrs, self.at)
        self.at.children.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(_Node(tag, attrs, self.at))

    def handle_endtag(self, tag):
        node = self.at
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def panel_items(html: str, label: str) -> list[dict]:
    """Items of the grid if the page is one, else of the first panel whose title holds the label."""
    tree = _Tree()
    tree.feed(html)
    tree.close()
    grid = tree.root.first(fx.GRID_CLASS)
    if grid is not None:
        found = []
        for item in grid.find_all(lambda n: fx.GRID_ITEM_CLASS in n.classes):
            name = item.first(fx.GRID_NAME_CLASS)
            found.append({"name": name.text() if name else fx.MISSING_TEXT, "title": item.attrs.get("title"),
                          "link": item.attrs.get("href"), "results_qty": None})
        return found
    for panel in tree.root.find_all(lambda n: fx.PANEL_CLASS in n.classes):
        title = panel.first(fx.PANEL_TITLE_CLASS, "h3")
        if title is not None and label in title.text():
            return [_list_item(i) for i in panel.find_all(lambda n: n.tag == "li" and fx.LIST_ITEM_CLASS in n.classes)]
    return []


def _list_item(item: _Node) -> dict:
    link, name = item.first(fx.LIST_LINK_CLASS, "a"), item.first(fx.LIST_NAME_CLASS)
    amount = item.first(fx.LIST_QUANTITY_CLASS)
    return {"name": name.text() if name else fx.MISSING_TEXT,
            "title": link.attrs.get("title") if link else fx.MISSING_TEXT,
            "link": link.attrs.get("href") if link else fx.MISSING_TEXT,
            "results_qty": amount.text() if amount else fx.NO_QUANTITY}




def compare(spark, pages, label="Versiones"):
    rows = spark.createDataFrame(list(enumerate(pages)), "page_id int, html string")
    got = {}
    for r in extract_panels(rows, label).collect():
        got.setdefault(r["page_id"], []).append((r["place"], {k: r[k] for k in ("name", "title", "link", "results_qty")}))
    for i, page in enumerate(pages):
        assert [x for _, x in sorted(got.get(i, []), key=lambda y: y[0])] == panel_items(page or "", label), page


def li(name, title="ver", href="/x", amount="(3)"):
    return (f'<li class="ui-search-filter-container"><a class="ui-search-link" title="{title}" href="{href}"><span class="ui-search-filter-name">{name}</span>'
            f'<span class="ui-search-filter-results-qty">{amount}</span></a></li>')


def panel(title, *items):
    return f'<div class="a ui-search-filter-dl b"><h3 class="ui-search-filter-dt-title">{title}</h3><ul>{"".join(items)}</ul></div>'


def test_panels(spark):
    deep = "<div><section>" * 30 + panel("Versiones", li("deep")) + "</section></div>" * 30
    compare(spark, [
        panel("Color", li("no")) + panel("Versiones", li("1.6 <b>GT</b> &amp; co"), li("a\n  b", "t &lt;x&gt;", "/q?a=1&amp;b=2", "( 7 )")),
        deep, None, "", "no panel", "<p>a < b</p>" + panel("Versiones", li("x")),
        panel("Color", panel("Versiones", li("inner")), li("outer")),                       # a panel in a panel
        panel("Otras Versiones de hoy", '<li class="ui-search-filter-container">bare</li>', "<li>other</li>", li("y")),
        "<!-- " + panel("Versiones", li("comment")) + " --><script>var a = '<div class=\"ui-search-filter-dl\">'</script>" + panel("Versiones", li("z<script>q</script>")),
        panel("Versiones", li("&aacute;&#233;&#xED; &unknown; &#x1F600; &#0; &# x", "d &quot;q&quot;")), panel("Versiones"),
        "<DIV CLASS='ui-search-filter-dl'><H3 class=ui-search-filter-dt-title>Versiones</H3><UL><LI Class=\"ui-search-filter-container\"><A href='/u' class=ui-search-link>q</A></LI></UL></DIV>",
    ])


def test_grids(spark):
    item = '<a class="ui-search-search-modal-filter" title="{0}" href="/{0}"><span class="ui-search-search-modal-filter-name">{0}<br>x</span></a>'
    grid = '<div class="ui-search-search-modal-grid-columns">' + "".join(item.format(k) for k in "abc") + '<a class="ui-search-search-modal-filter">bare</a></div>'
    compare(spark, [grid, panel("Versiones", li("no")) + grid + item.format("outside"), grid.replace("</div>", "")])


def test_broken_pages(spark):
    whole = "<body><nav>" + panel("Versiones", li("one"), li("two")) + "</nav><p>end</p>" + panel("Versiones", li("later")) + "</body>"
    pages = [whole.replace("</li>", ""), whole.replace("</div>", ""), whole.replace("</ul>", ""), whole.replace("</h3>", ""), whole.replace("</a>", ""),
             whole.replace("</nav>", "</div></nav></nav>"), "</div></li>" + whole, whole[:len(whole) // 2], whole.replace("<ul>", "<ul><br/><img class='ui-search-filter-name'>")]
    draw = random.Random(1)
    tags = ["<div>", "</div>", "<ul>", "</ul>", "</li>", "<span>", "</span>", "</a>", "<br>", "<p>", "</p>", "x & y", '<div class="ui-search-filter-dl">',
            '<h3 class="ui-search-filter-dt-title">Versiones</h3>', li("k"), li("m")[:-5], '<li class="ui-search-filter-container">', '<a class="ui-search-link" title="v">']
    pages += ["".join(draw.choice(tags) for _ in range(draw.randint(5, 60))) for _ in range(200)]
    compare(spark, pages)
