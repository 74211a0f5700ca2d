"""HTML to Markdown by way of a tree: nested lists, links, images, code, quotes, and tables whose spans are resolved.

The tree is built with a stack; end tags that HTML implies (of items, cells, rows, paragraphs, terms) are supplied. Below
MOST_DEPTH elements are hung into the last one, so that no page runs out of stack."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

MOST_DEPTH = 150

# What is dropped by default with all that it holds; heading styles.
STRIP = ("script", "style", "nav", "footer", "aside", "iframe", "form")
STYLES = ("atx", "atx_closed", "setext", "underlined")

_ALWAYS = frozenset(("head", "noscript", "template", "svg"))
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table ul".split()
)
#: An opening tag ends these, if they are open within the boundary that follows.
_ENDS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th", "caption"), ("table",)),
    "td": (("td", "th"), ("table", "tr")),
    "th": (("td", "th"), ("table", "tr")),
    "tbody": (("thead", "tbody", "tfoot", "caption"), ("table",)),
    "thead": (("thead", "tbody", "tfoot", "caption"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot", "caption"), ("table",)),
    "option": (("option",), ("select",)),
}
_MARKS = {"b": "**", "strong": "**", "i": "*", "em": "*", "del": "~~", "s": "~~", "strike": "~~"}


@dataclass
class Node:
    tag: str
    attrs: dict[str, str] = field(default_factory=dict)
    inside: list[Node | str] = field(default_factory=list)


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack = [Node("")]

    def _end(self, tags: tuple[str, ...], within: tuple[str, ...], first: bool = False) -> None:
        """Closes the outermost of these, or the first, that is open within the boundary."""
        found = None
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].tag in within:
                break
            if self.stack[k].tag in tags:
                found = k
                if first:
                    break
        if found is not None:
            del self.stack[found:]

    def handle_starttag(self, tag, attrs):
        if tag in _ENDS:
            self._end(*_ENDS[tag])
        elif tag in _BLOCKS:
            self._end(("p",), ("td", "th", "li", "blockquote", "div", "table"))
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.stack[-1].inside.append(node)
        if tag not in _VOID and len(self.stack) < MOST_DEPTH:
            self.stack.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._end((tag,), ("table",) if tag in ("td", "th", "tr", "li", "p") else (), first=True)

    def handle_data(self, data):
        self.stack[-1].inside.append(data)


def tree(html: str | None) -> Node:
    parser = _Tree()
    parser.feed(html or "")
    parser.close()
    return parser.stack[0]


class Writer:
    """Writes a tree as Markdown."""

    def __init__(self, strip: tuple[str, ...] = STRIP, bullets: str = "-", heading_style: str = "atx") -> None:
        if heading_style not in STYLES:
            raise ValueError(f"no such heading style: {heading_style}")
        self.strip, self.bullets, self.style = _ALWAYS | {*strip}, bullets or "-", heading_style

    def markdown(self, html: str | None) -> str:
        return "\n\n".join(self.blocks(tree(html))) + "\n"

    # ---- blocks

    def blocks(self, node: Node, depth: int = 0) -> list[str]:
        """The blocks within a node; text between blocks is a paragraph of its own."""
        out: list[str] = []
        run: list[Node | str] = []

        def paragraph() -> None:
            if text := self.text(run):
                out.append(text)
            run.clear()

        for x in node.inside:
            if isinstance(x, str) or x.tag not in _BLOCKS and not self._holds_blocks(x):
                run.append(x)
                continue
            paragraph()
            if x.tag not in self.strip:
                out += self.block(x, depth)
        paragraph()
        return out

    def _holds_blocks(self, node: Node) -> bool:
        """Whether an inline element, such as a link, has blocks within; it is then read as one."""
        return node.tag not in self.strip and any(not isinstance(x, str) and (x.tag in _BLOCKS or self._holds_blocks(x)) for x in node.inside)

    def block(self, node: Node, depth: int) -> list[str]:
        tag = node.tag
        if re.fullmatch("h[1-6]", tag):
            return self.heading(int(tag[1]), self.text(node.inside).replace("\n", " "))
        if tag == "hr":
            return ["---"]
        if tag == "pre":
            return [self.code(node)]
        if tag == "blockquote":
            text = "\n\n".join(self.blocks(node, depth))
            return ["\n".join(f"> {line}".rstrip() for line in text.split("\n"))] if text else []
        if tag in ("ul", "ol", "menu"):
            return self.items(node, depth)
        if tag == "table":
            return self.table(node)
        if tag == "dt":
            return [f"**{text}**"] if (text := self.text(node.inside)) else []
        if tag == "dd":
            found = "\n\n".join(self.blocks(node, depth))
            return [": " + found.replace("\n", "\n  ")] if found else []
        return self.blocks(node, depth)

    def heading(self, level: int, text: str) -> list[str]:
        if not text:
            return []
        if self.style in ("setext", "underlined") and level <= 2:
            return [f"{text}\n{'=-'[level - 1] * len(text)}"]
        marks = "#" * level
        return [f"{marks} {text} {marks}" if self.style == "atx_closed" else f"{marks} {text}"]

    def code(self, node: Node) -> str:
        text = self.plain(node).strip("\n")
        named = [node, *(x for x in node.inside if not isinstance(x, str))]
        found = [m[1] for x in named if (m := re.search(r"(?:^|\s)lang(?:uage)?-([\w+#.-]+)", x.attrs.get("class", "")))]
        fence = "`" * max(3, max((len(x) + 1 for x in re.findall("`{3,}", text)), default=3))
        return f"{fence}{found[0] if found else ''}\n{text}\n{fence}"

    def items(self, node: Node, depth: int) -> list[str]:
        """A list; what an item holds besides its first line is indented by the width of its mark."""
        start = node.attrs.get("start", "")
        number, out = int(start) if re.fullmatch(r"\d{1,9}", start) else 1, []
        for x in node.inside:
            if isinstance(x, str):
                if x.strip():
                    out.append(f"{self.bullets[depth % len(self.bullets)]} {self.text([x])}")
                continue
            if x.tag in self.strip:
                continue
            # a list that stands among items belongs to the item before
            nested = x.tag in ("ul", "ol", "menu") and out
            mark = " " * self._width if nested else f"{number}. " if node.tag == "ol" else f"{self.bullets[depth % len(self.bullets)]} "
            text = ""
            for block, is_list in self._item_blocks(x, depth + 1):
                text += ("" if not text else "\n" if is_list else "\n\n") + block
            self._width = len(mark)
            out.append(mark + re.sub(r"\n(?!\n|$)", "\n" + " " * len(mark), text) if text else mark.rstrip())
            number += not nested
        return ["\n".join(out)] if out else []

    _width = 2

    def _item_blocks(self, node: Node, depth: int) -> list[tuple[str, bool]]:
        if node.tag != "li":
            return [(b, True) for b in self.blocks(Node("", {}, [node]), depth)]
        out: list[tuple[str, bool]] = []
        run: list[Node | str] = []
        for x in [*node.inside, None]:
            if x is not None and (isinstance(x, str) or x.tag not in ("ul", "ol", "menu")):
                run.append(x)
                continue
            out += [(b, False) for b in self.blocks(Node("", {}, run), depth)]
            run = []
            if x is not None:
                out += [(b, True) for b in self.items(x, depth)]
        return out

    # ---- tables

    def table(self, node: Node) -> list[str]:
        """A table by its grid: a cell stands in every place that it spans. The first row is the head."""
        captions, rows = [], []
        self._rows(node, rows, captions)
        grid = spread([[(self.cell(c), _span(c, "colspan", 1000), _span(c, "rowspan", 65534)) for c in row] for row in rows])
        width = max(map(len, grid), default=0)
        out = [text for c in captions if (text := self.text(c.inside))]
        if not width:
            return out
        lines = ["| " + " | ".join(r + [""] * (width - len(r))) + " |" for r in grid]
        return [*out, "\n".join([lines[0], "| " + " | ".join(["---"] * width) + " |", *lines[1:]])]

    def _rows(self, node: Node, rows: list[list[Node]], captions: list[Node]) -> None:
        for x in node.inside:
            if isinstance(x, str) or x.tag in self.strip:
                continue
            if x.tag == "tr":
                if cells := [c for c in x.inside if not isinstance(c, str) and c.tag in ("td", "th")]:
                    rows.append(cells)
            elif x.tag == "caption":
                captions.append(x)
            elif x.tag in ("thead", "tbody", "tfoot"):
                self._rows(x, rows, captions)

    def cell(self, node: Node) -> str:
        return "<br>".join(line.strip() for block in self.blocks(node) for line in block.split("\n") if line.strip()).replace("|", "\\|")

    # ---- text

    def text(self, nodes: list[Node | str]) -> str:
        """Inline content as lines: white space is one space, and a break a line end."""
        found = "".join(map(self.inline, nodes))
        return "\n".join(line for x in re.sub(r"[ \t\r\f]+", " ", found).split("\n") if (line := x.strip()))

    def inline(self, x: Node | str) -> str:
        if isinstance(x, str):
            return re.sub(r"\s+", " ", x)
        if x.tag in self.strip:
            return ""
        if x.tag == "br":
            return "\n"
        if x.tag == "img":
            return f"![{x.attrs.get('alt', '')}]({x.attrs['src']}{_title(x)})" if x.attrs.get("src") else ""
        if x.tag in ("code", "kbd", "samp", "tt"):
            text = re.sub(r"\s+", " ", self.plain(x))
            ticks = "`" * (max(map(len, re.findall("`+", text)), default=0) + 1)
            pad = " " if "`" in text else ""
            return f"{ticks}{pad}{text}{pad}{ticks}" if text.strip() else text
        found = "".join(map(self.inline, x.inside))
        before, text, after = re.fullmatch(r"(\s*)(.*?)(\s*)", found, re.S).groups()
        if not text:
            return found
        if x.tag in _MARKS:
            return f"{before}{_MARKS[x.tag]}{text}{_MARKS[x.tag]}{after}"
        if x.tag == "a" and x.attrs.get("href"):
            return f"{before}[{text}]({x.attrs['href']}{_title(x)}){after}"
        return found

    def plain(self, x: Node | str) -> str:
        if isinstance(x, str):
            return x
        return "\n" if x.tag == "br" else "".join(map(self.plain, x.inside))


def _title(node: Node) -> str:
    return f' "{title}"' if (title := node.attrs.get("title", "").replace('"', "'").strip()) else ""


def _span(node: Node, name: str, most: int) -> int:
    found = node.attrs.get(name, "").strip()
    return max(1, min(int(found), most)) if re.fullmatch(r"\d{1,6}", found) else 1


def spread(rows: list[list[tuple[str, int, int]]]) -> list[list[str]]:
    """Cells (text, columns, rows) in their places; spans end with the table."""
    grid: list[dict[int, str]] = [{} for _ in rows]
    for y, row in enumerate(rows):
        x = 0
        for text, wide, high in row:
            while x in grid[y]:
                x += 1
            for below in grid[y : y + high]:
                for k in range(x, x + wide):
                    below.setdefault(k, text)
            x += wide
    return [[r.get(k, "") for k in range(max(r, default=-1) + 1)] for r in grid]


def markdown_of(html: str | None, strip: tuple[str, ...] = STRIP, bullets: str = "-", heading_style: str = "atx") -> str:
    """strip: elements dropped with all they hold. bullets: a mark for each depth of lists, in turn. heading_style: of STYLES."""
    return Writer(strip, bullets, heading_style).markdown(html)
