"""Stored listing pages -> filter-panel items -> flat catalogue.

A page is cut into tags and texts by a regex.  A fold over the tags keeps the stack
of open elements and notes where the elements of interest begin and end: an end
tag closes the nearest open element of its name and all inside it, and one
without such an element closes nothing.  What lies in a panel then follows from
places alone.  All of it is DataFrame functions within the row.
"""

from pyspark.sql import Column, DataFrame, functions as F

from lotwise import fixed_values as fx
from lotwise.functions.text import first_integer

VOID = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"]
TAG = r"""</?[A-Za-z](?:"[^"]*"|'[^']*'|[^'">])*>"""
TOKEN = TAG + r"|[^<]+|<"
#: Names of characters in texts and attributes; others, but for numbers, stay as they are.
ENTITIES = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": "\u00a0", "aacute": "á", "eacute": "é", "iacute": "í", "oacute": "ó",
            "uacute": "ú", "Aacute": "Á", "Eacute": "É", "Iacute": "Í", "Oacute": "Ó", "Uacute": "Ú", "ntilde": "ñ", "Ntilde": "Ñ",
            "uuml": "ü", "iexcl": "¡", "iquest": "¿", "ordm": "º", "ordf": "ª", "deg": "°", "euro": "€", "hellip": "…", "middot": "·"}
#: What an element may be, one bit each, with the tag it needs and its class.
GRID, GRID_ITEM, GRID_NAME, PANEL, TITLE, ITEM, LINK, NAME, AMOUNT = (1 << i for i in range(9))
KINDS = [(GRID, None, fx.GRID_CLASS), (GRID_ITEM, None, fx.GRID_ITEM_CLASS), (GRID_NAME, None, fx.GRID_NAME_CLASS),
         (PANEL, None, fx.PANEL_CLASS), (TITLE, "h3", fx.PANEL_TITLE_CLASS), (ITEM, "li", fx.LIST_ITEM_CLASS),
         (LINK, "a", fx.LIST_LINK_CLASS), (NAME, None, fx.LIST_NAME_CLASS), (AMOUNT, None, fx.LIST_QUANTITY_CLASS)]
OPEN, CLOSE, ALONE = 1, 2, 3
ELEMENTS = "array<struct<at:int,stop:int,kinds:int>>"


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute, null if the tag has none."""
    before = r"""(?s)^<[^\s/>]+(?:\s+|/|[^\s=>"']+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+))?)*?[\s/]"""
    value = rf"""(?i:{name})\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    found = F.concat(*[F.regexp_extract(tag, before + value, k) for k in (1, 2, 3)])
    return F.when(tag.rlike(before + value), unescaped(found))


def unescaped(text: Column) -> Column:
    """Character names and numbers as the characters."""
    for name, sign in ENTITIES.items():
        text = F.replace(text, F.lit(f"&{name};"), F.lit(sign))
    number = r"^([0-9]{1,7}|[xX][0-9a-fA-F]{1,6});?"

    def spelled(piece):
        digits = F.regexp_extract(piece, number, 1)
        code = F.when(F.lower(digits).startswith("x"), F.conv(F.substring(digits, 2, 6), 16, 10)).otherwise(digits).cast("int")
        sign = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        known = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        return F.when(piece.rlike(number), F.concat(F.when(known, sign).otherwise("\ufffd"), F.regexp_replace(piece, number, ""))).otherwise(
            F.concat(F.lit("&#"), piece))

    pieces = F.split(text, "&#", -1)
    numbered = F.concat(F.element_at(pieces, 1), F.array_join(F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), spelled), ""))
    text = F.when(F.contains(text, F.lit("&#")), numbered).otherwise(text)
    return F.replace(text, F.lit("&amp;"), F.lit("&"))


def tokens(html: Column) -> Column:
    """Tags and texts of a page in turn, without comments and without what scripts and styles hold."""
    bare = F.regexp_replace(html, r"(?s)<!--.*?-->|<![^>]*>|<\?[^>]*>", "")
    bare = F.regexp_replace(bare, r"(?is)<(script|style)\b([^>]*)>.*?</\1\s*>", "<$1$2></$1>")
    return F.regexp_extract_all(bare, F.lit(TOKEN), F.lit(0))


def _step(token: Column, at: Column) -> Column:
    """(at, act, name, kinds) of a tag."""
    name = F.lower(F.regexp_extract(token, r"^</?([A-Za-z][^\s/>]*)", 1))
    act = F.when(token.startswith("</"), CLOSE).when(name.isin(*VOID) | token.endswith("/>"), ALONE).otherwise(OPEN)
    classes = F.concat(F.lit(" "), F.regexp_replace(F.coalesce(attribute(token, "class"), F.lit("")), r"\s+", " "), F.lit(" "))

    def kinds(c):
        bits = [F.when(F.contains(c, F.lit(f" {cls} ")) & (F.lit(True) if tag is None else name == tag), bit).otherwise(0) for bit, tag, cls in KINDS]
        total = bits[0]
        for bit in bits[1:]:
            total = total + bit
        return total

    marked = F.when(F.contains(token, F.lit("ui-search")) & (act != CLOSE), bound(classes, kinds)).otherwise(0)
    return F.struct(at.alias("at"), act.alias("act"), name.alias("name"), marked.cast("int").alias("kinds"))


def elements(page: Column) -> Column:
    """(at, stop, kinds) of the elements of interest, in order, for the tokens of a page."""
    steps = F.filter(F.transform(page, lambda t, i: F.when(t.rlike(f"^{TAG}$"), _step(t, i))), lambda x: x.isNotNull())
    stack_type = "array<struct<name:string,at:int,kinds:int>>"
    start = F.struct(F.array().cast(stack_type).alias("stack"), F.array().cast(ELEMENTS).alias("out"))

    def ended(opened, stop):
        return F.transform(F.filter(opened, lambda s: s["kinds"] > 0), lambda s: F.struct(s["at"].alias("at"), stop.alias("stop"), s["kinds"].alias("kinds")))

    def act(acc, x):
        stack, out = acc["stack"], acc["out"]
        back = F.array_position(F.transform(F.reverse(stack), lambda s: s["name"]), x["name"]).cast("int")
        here = F.array(F.struct(x["at"].alias("at"), x["at"].alias("stop"), x["kinds"].alias("kinds")))
        opened = F.concat(stack, F.array(F.struct(x["name"].alias("name"), x["at"].alias("at"), x["kinds"].alias("kinds"))))
        opens = F.struct(opened.cast(stack_type).alias("stack"), out.alias("out"))
        stands = F.struct(stack.alias("stack"), F.concat(out, F.when(x["kinds"] > 0, here).otherwise(F.array().cast(ELEMENTS))).cast(ELEMENTS).alias("out"))

        def closes(k):
            kept = F.size(stack) - k
            return F.struct(F.slice(stack, F.lit(1), kept).cast(stack_type).alias("stack"),
                            F.concat(out, ended(F.slice(stack, kept + 1, F.when(k > 0, k).otherwise(F.lit(0))), x["at"])).cast(ELEMENTS).alias("out"))

        return F.when(x["act"] == OPEN, opens).when(x["act"] == ALONE, stands).otherwise(bound(back, closes))

    # What is still open ends with the page.
    found = F.aggregate(steps, start, act, lambda acc: F.concat(acc["out"], ended(acc["stack"], F.size(page))))
    return F.array_sort(found)


def _has(x: Column, kind: int) -> Column:
    return x["kinds"].bitwiseAND(F.lit(kind)) > 0


def _inside(found: Column, outer: Column, kind: int) -> Column:
    """Elements of a kind inside another one, in order."""
    return F.filter(found, lambda x: (x["at"] > outer["at"]) & (x["at"] < outer["stop"]) & _has(x, kind))


def _text(page: Column, x: Column) -> Column:
    """The texts inside an element, one blank for every white space."""
    parts = F.filter(F.slice(page, x["at"] + 2, F.greatest(x["stop"] - x["at"] - 1, F.lit(0))), lambda t: ~t.rlike(f"^{TAG}$"))
    return F.trim(F.regexp_replace(unescaped(F.array_join(parts, "")), r"(?U)\s+", " "))


def panel_items(page: Column, found: Column, label: str) -> Column:
    """Items of the grid if the page is one, else of the first panel whose title holds the label."""
    def tag(x):
        return F.element_at(page, x["at"] + 1)

    def first(outer, kind):
        return F.get(_inside(found, outer, kind), F.lit(0))

    def known(value, missing):
        return F.coalesce(value, F.lit(missing))

    def item(name, title, link, amount):
        return F.struct(name.alias("name"), title.alias("title"), link.alias("link"), amount.alias("results_qty"))

    def of_grid(x):
        return item(bound(first(x, GRID_NAME), lambda n: F.when(n.isNull(), fx.MISSING_TEXT).otherwise(_text(page, n))),
                    attribute(tag(x), "title"), attribute(tag(x), "href"), F.lit(None).cast("string"))

    def of_list(x):
        def part(kind, missing, value):
            return bound(first(x, kind), lambda n: F.when(n.isNull(), F.lit(missing)).otherwise(value(n)))
        return item(part(NAME, fx.MISSING_TEXT, lambda n: _text(page, n)), part(LINK, fx.MISSING_TEXT, lambda n: attribute(tag(n), "title")),
                    part(LINK, fx.MISSING_TEXT, lambda n: attribute(tag(n), "href")), part(AMOUNT, fx.NO_QUANTITY, lambda n: _text(page, n)))

    def titled(p):
        return bound(first(p, TITLE), lambda t: F.when(t.isNull(), False).otherwise(F.contains(_text(page, t), F.lit(label))))

    grid = F.get(F.filter(found, lambda x: _has(x, GRID)), F.lit(0))
    panel = F.get(F.filter(found, lambda x: _has(x, PANEL) & titled(x)), F.lit(0))
    none = F.array().cast("array<struct<name:string,title:string,link:string,results_qty:string>>")
    of_panel = bound(panel, lambda p: F.when(p.isNull(), none).otherwise(F.transform(_inside(found, p, ITEM), of_list)))
    return bound(grid, lambda g: F.when(g.isNull(), of_panel).otherwise(F.transform(_inside(found, g, GRID_ITEM), of_grid)))


def extract_panels(pages: DataFrame, label: str, html: str = "html") -> DataFrame:
    """One row per panel item, with the page's other columns and its ``place``; pages stay where they are.

    Null pages and pages without a panel or a grid have no items.
    """
    kept = [F.col(f"`{c}`") for c in pages.columns if c != html]
    text = F.coalesce(F.col(f"`{html}`"), F.lit(""))
    items = bound(tokens(text), lambda page: bound(elements(page), lambda found: panel_items(page, found, label)))
    worth = F.contains(text, F.lit(fx.GRID_CLASS)) | F.contains(text, F.lit(fx.PANEL_CLASS))
    return pages.where(worth).select(*kept, F.posexplode(items).alias("place", "item")).select(*kept, "place", "item.*")


# ------------------------------------------------------------------ catalogue
def flatten_catalogue(brands: DataFrame) -> DataFrame:
    """(brand, model, version, quantity): nested brand -> models -> versions; empty levels keep one row."""
    def known(c):
        return F.coalesce(c, F.lit(fx.MISSING_TEXT))
    models = brands.select(F.col("brand_name").alias("brand"), F.explode_outer("models").alias("m"))
    rows = models.select("brand", F.col("m.name").alias("model"), F.explode_outer("m.versions").alias("v"))
    return rows.select("brand", known(F.col("model")).alias("model"), known(F.col("v.name")).alias("version"),
                       first_integer(F.coalesce(F.col("v.results_qty"), F.lit(fx.NO_QUANTITY))).alias("quantity"))


def sort_catalogue(flat: DataFrame) -> DataFrame:
    return flat.orderBy("brand", "model", F.desc("quantity"), "version")
