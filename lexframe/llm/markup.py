"""Clean, still structured text from HTML, Markdown, wiki and LaTeX, alone or mixed.

Every notation is read into one kind of tree (sections, paragraphs, headings, lists, code,
tables). Paragraphs pass points for their length and commas to their ancestors, discounted by
the share of their text that is links, and names of tags and classes add or take some; the best container is kept
with its siblings and those of its ancestors. Blocks that are mostly links go, and where such blocks or others that
name themselves as menus, footers or comments show the frame of a page, everything beside the way to the best that
has few points compared with it. What is kept is given as text; elements are those of the whole tree and
say whether they stand in what is kept.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# Tags.
BLOCK = {"p", "div", "ul", "ol", "li", "table", "tr", "td", "th", "thead", "tbody", "caption", "pre", "blockquote", "section", "article", "main", "nav", "aside", "header", "footer", "form", "dl", "dt", "dd", "html", "body", "h1", "h2", "h3", "h4", "h5", "h6"}
VOID = {"br", "hr", "img", "input", "meta", "link", "wbr", "col", "area", "base", "embed", "source", "track"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
HIDDEN = {"style", "script", "head", "title", "noscript", "template"}
FRAME = {"nav", "aside", "header", "footer", "form"}
# Words in the class, id or role of a block that speak for content, and for the frame of a page.
CONTENT_WORDS = {"article", "body", "content", "entry", "main", "post", "story", "text"}
FRAME_WORDS = {"ad", "ads", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "contact", "cookie", "footer", "header", "login", "menu", "nav", "navbar", "navigation", "pagination", "promo", "related", "search", "share", "sidebar", "social", "sponsor", "widget"}
# End of the fixed values.

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_LAYOUT = re.compile(r"</?(?:p|div|ul|ol|li|table|t[rdh]|h[1-6]|html|body|blockquote|section|article)\b(?:[^<>\"']|\"[^\"]*\"|'[^']*')*>", re.I)
_GUARDED = re.compile(r"<!--.*?-->|<(pre|script|style|source|syntaxhighlight)\b(?:[^<>\"']|\"[^\"]*\"|'[^']*')*>.*?</\1\s*>|^ {0,3}(```+|~~~+)[^\n]*\n.*?^ {0,3}\2[`~]*[ \t]*$|\\begin\{(verbatim|lstlisting)\*?\}.*?\\end\{\3\*?\}", re.S | re.I | re.M)
_HOLD, _HELD = "\ue000{}\ue001", re.compile("\ue000(\\d+)\ue001")
_WHITE = re.compile(r"\s+")
#: Attributes before the text of a wiki table's cell.
_ATTRIBUTES = re.compile(r"\s*(?:[A-Za-z][\w:-]*\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'|]++)\s*+|(?:nowrap|noresize)\b\s*+)*", re.I)
#: Wiki tables within each other; the rows of those further in join those of the last.
DEEPEST = 30


class Node:
    """A tag with its children, nodes and strings."""

    __slots__ = ("kids", "tag", "weight")

    def __init__(self, tag: str, kids: list | None = None, weight: int = 0):
        self.tag = tag
        self.kids: list = kids if kids is not None else []
        self.weight = weight


class Reader:
    """Reads one document; formulas stand as numbered marks in texts."""

    def __init__(self) -> None:
        self.formulas: list[str] = []
        self.codes: list[str] = []

    def formula(self, tex: str) -> str:
        self.formulas.append(_WHITE.sub(" ", tex).strip())
        return _HOLD.format(len(self.formulas) - 1)

    def read(self, source: str) -> Node:
        source = source.replace("\r\n", "\n").replace("\r", "\n").replace("\ue000", "").replace("\ue001", "")
        root = Node("body")
        for is_html, text in _parts(source):
            if is_html:
                self.read_html(text, root)
            else:
                kind = notation(text)
                if kind:
                    {"latex": self.read_latex, "wiki": self.read_wiki, "markdown": self.read_markdown}[kind](text, root)
                else:
                    root.kids += [Node("p", [p]) for p in re.split(r"\n\s*\n", text) if p.strip()]
        return root

    # --- HTML ---

    _inline_math = re.compile(r"\\\((.+?)\\\)|\\\[(.+?)\\\]|\$\$(.+?)\$\$", re.S)

    def _math_in(self, text: str) -> str:
        if "\\" not in text and "$$" not in text:
            return text
        return self._inline_math.sub(lambda m: self.formula(next(g for g in m.groups() if g is not None)), text)

    def read_html(self, text: str, root: Node) -> None:
        stack = [root]
        at = 0
        pending: list[str] = []

        def flush() -> None:
            if pending:
                stack[-1].kids.append(self._math_in(html.unescape("".join(pending))))
                pending.clear()

        while m := _TAG.search(text, at):
            pending.append(text[at : m.start()])
            at = m.end()
            if not m.group(2):
                continue
            closing, tag, attributes = m.group(1), m.group(2).lower(), m.group(3)
            if tag in ("script", "style", "math") and not closing:
                end = re.compile(rf"</{tag}\s*>", re.I).search(text, at)
                body = text[at : end.start() if end else len(text)]
                at = end.end() if end else len(text)
                if tag == "math" and "<" not in body:
                    pending.append(self.formula(html.unescape(body)))
                elif tag == "script" and "math/tex" in attributes:
                    pending.append(self.formula(body))
                continue
            if tag == "br":
                pending.append("\n")
                continue
            if tag in VOID:
                continue
            if tag not in BLOCK and tag not in HIDDEN and tag != "a":
                continue  # inline markup: only its text counts
            if tag == "pre" and not closing:
                flush()
                if stack[-1].tag == "p":
                    stack.pop()
                end = re.compile(r"</pre\s*>", re.I).search(text, at)
                body = text[at : end.start() if end else len(text)]
                at = end.end() if end else len(text)
                stack[-1].kids.append(Node("pre", [html.unescape(_TAG.sub("", body))]))
                continue
            flush()
            if closing:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == tag:
                        del stack[i:]
                        break
                    if stack[i].tag in ("ul", "ol", "table") and tag in ("li", "p", "a"):
                        break
                continue
            if tag in BLOCK:
                while len(stack) > 1 and stack[-1].tag in ("p", "a", *HEADINGS):
                    stack.pop()
            if tag in ("li", "td", "th", "tr", "dt", "dd"):
                bound = {"li": ("ul", "ol"), "td": ("tr", "table"), "th": ("tr", "table"), "tr": ("table", "tbody", "thead"), "dt": ("dl",), "dd": ("dl",)}[tag]
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in bound:
                        break
                    if stack[i].tag == tag or tag in ("dt", "dd") and stack[i].tag in ("dt", "dd"):
                        del stack[i:]
                        break
            node = Node(tag, weight=_weight(tag, attributes))
            stack[-1].kids.append(node)
            stack.append(node)
        pending.append(text[at:])
        flush()

    # --- LaTeX ---

    _tex_math = re.compile(r"\\begin\{(equation|align|gather|displaymath|math|multline|eqnarray)(\*?)\}(.*?)\\end\{\1\2\}|\\\[(.+?)\\\]|\\\((.+?)\\\)|(?<!\\)\$\$(.+?)(?<!\\)\$\$|(?<!\\)\$([^$\n]+?)(?<!\\)\$", re.S)
    _tex_command = re.compile(r"\\begin\{(\w+\*?)\}(?:\[[^\]]*\])?|\\end\{(\w+\*?)\}|\\item\b\s*(?:\[[^\]]*\])?|\\((?:sub)*section|chapter|part|(?:sub)?paragraph)\*?\s*(?:\[[^\]]*\])?(?=\{)")
    _tex_code = re.compile(r"\\begin\{(verbatim|lstlisting)(\*?)\}(?:\[[^\]\n]*\])?(.*?)\\end\{\1\2\}", re.S)

    def read_latex(self, text: str, root: Node) -> None:
        codes: list[str] = []

        def hold(m: re.Match) -> str:
            codes.append(m.group(3))
            return f"\n\n\ue002{len(codes) - 1}\ue003\n\n"

        text = self._tex_code.sub(hold, text)
        text = re.sub(r"(?<!\\)%[^\n]*", "", text)
        text = re.sub(r"<!--.*?-->", "", text, flags=re.S)
        text = self._tex_math.sub(lambda m: self.formula(next(g for g in m.groups()[2:] if g is not None)), text)
        text = re.sub(r"\\(?:documentclass|usepackage|title|author|date)\s*(?:\[[^\]]*\])?\{[^}]*\}|\\maketitle\b|\\label\{[^}]*\}", "", text)
        stack = [root]
        at = 0

        def add(piece: str) -> None:
            for k, part in enumerate(re.split("\ue002(\\d+)\ue003", piece)):
                if k % 2:
                    stack[-1].kids.append(Node("pre", [codes[int(part)]]))
                    continue
                if stack[-1].tag == "li":
                    stack[-1].kids.append(tex_text(part))
                else:
                    stack[-1].kids += [Node("p", [tex_text(p)]) for p in re.split(r"\n\s*\n", part) if p.strip()]

        while m := self._tex_command.search(text, at):
            add(text[at : m.start()])
            at = m.end()
            if m.group(1):
                name = m.group(1).rstrip("*")
                tag = {"itemize": "ul", "enumerate": "ol", "description": "ul", "tabular": "table", "table": "table", "longtable": "table"}.get(name)
                if tag:
                    node = Node(tag)
                    stack[-1].kids.append(node)
                    stack.append(node)
                    if tag == "table":
                        at = _after_braces(text, at)
            elif m.group(2):
                name = m.group(2).rstrip("*")
                tag = {"itemize": "ul", "enumerate": "ol", "description": "ul", "tabular": "table", "table": "table", "longtable": "table"}.get(name)
                for i in range(len(stack) - 1, 0, -1):
                    if tag and stack[i].tag == tag:
                        del stack[i:]
                        break
            elif m.group(3):
                end = _after_braces(text, at)
                while len(stack) > 1 and stack[-1].tag in ("li", "ul", "ol"):
                    stack.pop()
                stack[-1].kids.append(Node("h2", [tex_text(text[at + 1 : end - 1])]))
                at = end
            else:
                while stack[-1].tag == "li":
                    stack.pop()
                node = Node("li")
                stack[-1].kids.append(node)
                stack.append(node)
        add(text[at:])

    # --- wiki ---

    def read_wiki(self, text: str, root: Node) -> None:
        codes: list[str] = []

        def hold(m: re.Match) -> str:
            codes.append(m.group(2))
            return f"\n\ue002{len(codes) - 1}\ue003\n"

        text = re.sub(r"<(pre|source|syntaxhighlight)\b[^>]*>(.*?)</\1\s*>", hold, text, flags=re.S | re.I)
        text = re.sub(r"<!--.*?-->", "", text, flags=re.S)
        text = re.sub(r"<math\b[^>]*>(.*?)</math\s*>", lambda m: self.formula(m.group(1)), text, flags=re.S | re.I)
        text = re.sub(r"<ref\b[^>/]*/>|<ref\b[^>]*>.*?</ref\s*>|\{\{[^{}]*\}\}", "", text, flags=re.S | re.I)
        lines = text.split("\n")
        closed = _closed_tables(lines)
        tables: list[_Table] = []
        paragraph: list[str] = []
        lists: list[Node] = []

        def put(node: Node) -> None:
            (tables[-1].block() if tables else root).kids.append(node)

        def flush() -> None:
            if paragraph:
                put(Node("p", [wiki_text("\n".join(paragraph))]))
                paragraph.clear()

        for at, line in enumerate(lines):
            code = re.fullmatch("\\s*\ue002(\\d+)\ue003\\s*", line)
            if code:
                flush()
                lists = []
                put(Node("pre", [codes[int(code.group(1))]]))
                continue
            heading = re.match(r"(={1,6})\s*(.+?)\s*\1\s*$", line)
            if tables and not tables[-1].closed and (heading or not line.strip()):
                flush()
                tables.clear()  # what holds an open table is open, too
            bare = line.strip()
            if re.match(r":*\s*\{\|", bare):
                flush()
                lists = []
                if len(tables) < DEEPEST:
                    put(node := Node("table"))
                else:
                    node = tables[-1].node
                tables.append(_Table(node, at in closed))
                continue
            if tables and bare.startswith(("|", "!")):
                flush()
                lists = []
                if bare.startswith("|}"):
                    tables.pop()
                    if bare[2:].strip():
                        paragraph.append(bare[2:])
                else:
                    tables[-1].read(bare)
                continue
            item = None if heading else re.match(r"([*#]+)[:;]*\s*(.*)", line)
            if heading or item or not line.strip():
                flush()
            if heading:
                lists = []
                put(Node("h2", [wiki_text(heading.group(2))]))
            elif item and tables and tables[-1].cell is None:
                put(Node("p", [wiki_text(item.group(2))]))  # in a table, but in none of its cells
            elif item:
                depth = len(item.group(1))
                lists = lists[:depth]
                while len(lists) < depth:
                    node = Node("ol" if item.group(1)[len(lists)] == "#" else "ul")
                    if lists:
                        (lists[-1].kids[-1] if lists[-1].kids else lists[-1]).kids.append(node)
                    else:
                        put(node)
                    lists.append(node)
                lists[-1].kids.append(Node("li", [wiki_text(item.group(2))]))
            else:
                lists = []
                if line.strip():
                    paragraph.append(re.sub(r"^[:;]+\s*", "", line))
        flush()

    # --- Markdown ---

    _md_math = re.compile(r"(?<!\\)\$\$(.+?)(?<!\\)\$\$|(?<![\\$\w])\$(?=[^\s$])([^$\n]*?[^\s\\$])\$(?![\d$])", re.S)

    def read_markdown(self, text: str, root: Node) -> None:
        codes: list[str] = []

        def hold(body: str) -> str:
            codes.append(body)
            return f"\ue002{len(codes) - 1}\ue003"

        text = re.sub(r"^( {0,3})(```+|~~~+)[^\n]*\n(.*?)(?:^ {0,3}\2[`~]*[ \t]*$|\Z)", lambda m: hold(m.group(3)) + "\n", text, flags=re.S | re.M)
        text = re.sub(r"<pre\b[^>]*>(.*?)</pre\s*>", lambda m: hold(html.unescape(_TAG.sub("", m.group(1)))), text, flags=re.S | re.I)
        text = re.sub(r"<!--.*?-->", "", text, flags=re.S)
        text = re.sub(r"<(script|style)\b[^>]*>.*?</\1\s*>", "", text, flags=re.S | re.I)
        text = re.sub(r"(?<![`\\])(`+)(?!`)(.+?)(?<!`)\1(?!`)", lambda m: m.group(2), text)
        text = self._md_math.sub(lambda m: self.formula(next(g for g in m.groups() if g is not None)), text)
        paragraph: list[str] = []
        lists: list[tuple[int, Node]] = []  # (column of the contents, list)
        item: Node | None = None
        blank = True

        def flush() -> None:
            nonlocal item
            if paragraph:
                (item.kids if item else root.kids).append(markdown_text("\n".join(paragraph)) if item else Node("p", [markdown_text("\n".join(paragraph))]))
                paragraph.clear()

        def leave() -> None:
            nonlocal item
            flush()
            item = None
            lists.clear()

        for line in text.split("\n"):
            line = line.expandtabs(4)
            body = line.strip()
            indent = len(line) - len(line.lstrip())
            if not body:
                flush()
                blank = True
                continue
            code = re.fullmatch("\ue002(\\d+)\ue003", body)
            marker = re.match(r"( *)([*+-]|\d{1,9}[.)])( +)(.*)", line)
            if code:
                if not (lists and indent >= lists[0][0]):
                    leave()
                else:
                    flush()
                (item or root).kids.append(Node("pre", [codes[int(code.group(1))]]))
            elif m := re.match(r" {0,3}#{1,6}(?:\s+(.*?))?(?:\s+#+)?\s*$", line):
                leave()
                root.kids.append(Node("h2", [markdown_text(m.group(1) or "")]))
            elif re.fullmatch(r"=+|-+", body) and paragraph and not item and indent < 4:
                heading = markdown_text("\n".join(paragraph))
                paragraph.clear()
                root.kids.append(Node("h2", [heading]))
            elif re.fullmatch(r"(?:[-*_] *){3,}", body) and indent < 4:
                leave()
            elif body.startswith("|"):
                leave()
                root.kids.append(Node("table", [Node("tr", [markdown_text(body)])]))
            elif marker and (indent < 4 or lists):
                flush()
                while lists and indent < lists[-1][0] - 1 and indent <= lists[-1][0] - 2:
                    lists.pop()
                if not lists:
                    node = Node("ul")
                    root.kids.append(node)
                    lists.append((indent + len(marker.group(2)) + 1, node))
                elif indent >= lists[-1][0] and item is not None:
                    node = Node("ul")
                    item.kids.append(node)
                    lists.append((indent + len(marker.group(2)) + 1, node))
                item = Node("li")
                lists[-1][1].kids.append(item)
                paragraph.append(marker.group(4))
            elif blank and indent >= 4 and not lists and not paragraph:
                last = root.kids[-1] if root.kids else None
                if isinstance(last, Node) and last.tag == "pre" and last.kids[:1] == ["\ue004"]:
                    last.kids.append(line[4:] + "\n")
                else:
                    root.kids.append(Node("pre", ["\ue004", line[4:] + "\n"]))
                continue
            else:
                if blank and item is not None and indent < 2:
                    leave()
                paragraph.append(line)
            blank = False
        flush()


class _Table:
    """A wiki table while it is read."""

    __slots__ = ("cell", "closed", "node", "row")

    def __init__(self, node: Node, closed: bool):
        self.node, self.closed = node, closed
        self.row: Node | None = None
        self.cell: Node | None = None

    def read(self, line: str) -> None:
        """A line that begins a row, a caption or cells."""
        self.cell = None
        if line.startswith("|-"):
            self.row = None
            return
        caption, head = line.startswith("|+"), line.startswith("!")
        if self.row is None and not caption:
            self.row = Node("tr")
            self.node.kids.append(self.row)
        for text in [line[2:]] if caption else (line.replace("!!", "||") if head else line)[1:].split("||"):
            attributes, bar, content = text.partition("|")
            if bar and _ATTRIBUTES.fullmatch(attributes):
                text = content
            self.cell = Node("p" if caption else "th" if head else "td", [wiki_text(text)] if text.strip() else [])
            (self.node if caption else self.row).kids.append(self.cell)

    def block(self) -> Node:
        """Where a block goes: into the cell, the text of which becomes a block as well, or else into the table."""
        if self.cell is None:
            return self.node
        if self.cell.tag != "div":
            self.cell.tag, self.cell.kids = "div", [Node("p", self.cell.kids)] if self.cell.kids else []
        return self.cell


def _closed_tables(lines: list[str]) -> set[int]:
    """The lines that begin a wiki table which is closed further down."""
    begun: list[int] = []
    out = set()
    for i, line in enumerate(lines):
        if re.match(r"\s*:*\s*\{\|", line):
            begun.append(i)
        elif begun and line.lstrip().startswith("|}"):
            out.add(begun.pop())
    return out


def _after_braces(text: str, at: int) -> int:
    """The place after the group in braces that begins at `at`, or `at` where none does."""
    if text[at : at + 1] != "{":
        return at
    depth = 0
    for i in range(at, len(text)):
        c = text[i]
        if c == "{" and text[i - 1] != "\\":
            depth += 1
        elif c == "}" and text[i - 1] != "\\":
            depth -= 1
            if not depth:
                return i + 1
    return len(text)


def tex_text(text: str) -> str:
    """LaTeX without commands, for a reader."""
    text = text.replace("\\\\", " ").replace("~", " ")
    text = re.sub(r"\\text(greater|less)\b(?:\{\})?\s?", lambda m: ">" if m.group(1) == "greater" else "<", text)
    text = re.sub(r"\\([%&#_{}$])", lambda m: f"\ue005{ord(m.group(1))}\ue006", text)
    before = None
    while before != text:
        before = text
        text = re.sub(r"\\footnote\{[^{}]*\}", "", text)
        text = re.sub(r"\\href\{[^{}]*\}\{([^{}]*)\}", r"\1", text)
        text = re.sub(r"\\[A-Za-z]+\*?\{([^{}]*)\}", r"\1", text)
        text = re.sub(r"\{(?:\\[A-Za-z]+\s*)?([^{}]*)\}", r"\1", text)
    text = re.sub(r"\\[A-Za-z]+\*?\s?", "", text).replace("``", "“").replace("''", "”")
    text = re.sub(r"&", " ", text)
    return re.sub("\ue005(\\d+)\ue006", lambda m: chr(int(m.group(1))), text)


def wiki_text(text: str) -> str:
    """Wiki text without inline markup."""
    text = re.sub(r"\[\[(?:[^\[\]|]*\|)?([^\[\]|]*)\]\]", r"\1", text)
    text = re.sub(r"\[(?:https?|ftp)://[^\s\]]+\s*([^\]]*)\]", r"\1", text)
    text = re.sub(r"'{2,5}", "", text)
    return html.unescape(_TAG.sub("", text))


def markdown_text(text: str) -> str:
    """Markdown without inline markup; escapes and character references resolved."""
    text = re.sub(r"\\([!-/:-@\[-`{-~])", lambda m: f"\ue005{ord(m.group(1))}\ue006", text)
    text = re.sub(r"!?\[([^\[\]]*)\]\([^()\s]*(?:\s+\"[^\"]*\")?\)", r"\1", text)
    text = re.sub(r"<((?:https?|mailto):[^<>\s]+)>", r"\1", text)
    text = _TAG.sub("", text)
    text = _without_emphasis(text)
    return re.sub("\ue005(\\d+)\ue006", lambda m: chr(int(m.group(1))), html.unescape(text))


_RUN = re.compile(r"\*+|_+|~~")


def _without_emphasis(text: str) -> str:
    """The text without pairs of equal marks around words; a mark that has no partner stays. One pass, however long the text is."""
    openers: dict[str, int] = {}
    gone: list[tuple[int, int]] = []
    for m in _RUN.finditer(text):
        run, (a, b) = m.group(), m.span()
        if len(run) > 3:
            continue
        before, after = text[a - 1 : a], text[b : b + 1]
        inside = run[0] == "_" and (before.isalnum() or before == "_"), run[0] == "_" and (after.isalnum() or after == "_")
        if run in openers and before.strip() and not inside[1] and openers[run] + len(run) < a:
            gone += [(openers[run], openers[run] + len(run)), (a, b)]
            del openers[run]
        elif after.strip() and not inside[0]:
            openers[run] = a
    if not gone:
        return text
    kept, at = [], 0
    for a, b in sorted(gone):
        kept.append(text[at:a])
        at = b
    return "".join([*kept, text[at:]])


def _parts(source: str) -> list[tuple[bool, str]]:
    """The document as runs of HTML and of other text; blocks are told apart by layout tags, at empty lines."""
    held: list[str] = []

    def hold(m: re.Match) -> str:
        held.append(m.group())
        return f"\ue002{len(held) - 1}\ue003"

    masked = _GUARDED.sub(hold, source)
    if not _LAYOUT.search(masked):
        return [(False, source)]
    back = lambda t: re.sub("\ue002(\\d+)\ue003", lambda m: held[int(m.group(1))], t)
    runs: list[tuple[bool, list[str]]] = []
    for block in re.split(r"\n[ \t]*\n", masked):
        inner = re.sub(r"^(?:\s*</[A-Za-z]+\s*>)+\s*$", "", block, flags=re.M)
        if not re.sub("\ue002\\d+\ue003", "", inner).strip():
            is_html = runs[-1][0] if runs else True
        else:
            is_html = bool(_LAYOUT.search(inner))
        text = block if is_html else inner
        if runs and runs[-1][0] == is_html:
            runs[-1][1].append(text)
        else:
            runs.append((is_html, [text]))
    return [(is_html, back("\n\n".join(blocks))) for is_html, blocks in runs]


_LATEX = re.compile(r"\\(?:(?:sub)*section\*?\s*\{|begin\{|documentclass|textbf\{|emph\{|href\{|item\b|footnote\{)|\{\\(?:bf|it|em)\b")
_WIKI = re.compile(r"^={1,6}[^=\n].*?[^=\n]={1,6}[ \t]*$|'''?[^'\n]+'''?|\[\[[^\[\]\n]+\]\]|\[https?://[^\s\]]+ [^\]\n]+\](?!\()|<nowiki|<ref\b|<math\b|<source\b|<syntaxhighlight\b|^\{\||^[*#]+[^\s*#]", re.M)
_MARKDOWN = re.compile(r"^ {0,3}#{1,6}\s|^\S[^\n]*\n(?:=+|-{2,})[ \t]*$|\*\*\S|__\S|\]\([^)\s]+\)|^ {0,3}(?:```|~~~)|^\s*(?:[*+-]|\d{1,9}[.)])\s+\S|(?<!\w)\*\S[^*\n]*\S?\*(?!\w)|\$\$|(?<![\\\w$])\$(?=[^\s$])[^$\n]*[^\s\\$]\$(?![\d$])|^\|.*\|[ \t]*$|\\[*_#$<>\[\]]", re.M)


def notation(text: str) -> str:
    """`latex`, `wiki`, `markdown`, or nothing for text without markup; code is not looked at."""
    shown = _GUARDED.sub(lambda m: "\ue002" if m.group(1) is None or m.group(1).lower() == "pre" else f"<{m.group(1)}>", text)
    if _LATEX.search(shown) or re.search(r"\\begin\{(?:verbatim|lstlisting)", text):
        return "latex"
    wiki, markdown = len(_WIKI.findall(shown)), len(_MARKDOWN.findall(shown))
    if wiki and (re.search(r"^={1,6}[^=\n].*?[^=\n]={1,6}[ \t]*$", shown, re.M) or wiki >= markdown or "<math" in shown or "'''" in shown or "[[" in shown):
        if not re.search(r"^\S[^\n]*\n(?:={3,}|-{3,})[ \t]*$|^ {0,3}#{2,6} \S", shown, re.M) or re.search(r"^={2,6}[^=\n].*?[^=\n]={2,6}[ \t]*$", shown, re.M):
            return "wiki"
    if markdown or _GUARDED.search(text):
        return "markdown" if markdown or re.search(r"^ {0,3}(?:```|~~~)", text, re.M) or re.search(r"<pre\b", text, re.I) else ""
    return ""


# --- scoring ------------------------------------------------------------------------------------


_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PARTS = re.compile(r"[A-Za-z][a-z]*")
#: Points for a name, levels of ancestors that a paragraph scores for, share of the best score that others need in a page's frame.
NAMED, LEVELS, SHARE = 25, 5, 0.2


def _weight(tag: str, attributes: str) -> int:
    """Points that a block has from its tag and the names in its attributes."""
    if tag == "a":
        return 0
    names = {w.lower() for m in _NAMES.finditer(attributes) for w in _PARTS.findall(m.group(m.lastindex) if m.lastindex else "")} if attributes.strip() else set()
    if tag in FRAME or names & FRAME_WORDS:
        return -NAMED
    return NAMED if tag in ("article", "main") or names & CONTENT_WORDS else 0


class Scores:
    """What the blocks of a tree are worth; without recursion, as pages can be nested thousands of levels deep."""

    def __init__(self, root: Node):
        self.letters: dict[int, int] = {}
        self.links: dict[int, int] = {}
        self.points: dict[int, float] = {}  # passed on by paragraphs below, to the containers above
        self.own: dict[int, float] = {}  # of all paragraphs below
        way: list[Node] = []
        stack: list[tuple[Node, bool, bool]] = [(root, False, False)]
        while stack:
            node, linked, done = stack.pop()
            if not done:
                way.append(node)
                stack.append((node, linked, True))
                stack += [(k, linked or k.tag == "a", False) for k in node.kids if not isinstance(k, str) and k.tag not in HIDDEN]
                continue
            way.pop()
            here = sum(len(k.strip()) for k in node.kids if isinstance(k, str))
            below = [k for k in node.kids if not isinstance(k, str)]
            letters = here + sum(self.letters.get(id(k), 0) for k in below)
            self.letters[id(node)] = letters
            self.links[id(node)] = here * linked + sum(self.links.get(id(k), 0) for k in below)
            own = sum(self.own.get(id(k), 0.0) for k in below)
            if node.tag in ("p", "li", "pre", "td", "blockquote") and letters >= 25:
                points = 1 + sum(k.count(",") for k in node.kids if isinstance(k, str)) + min(letters // 100, 3)
                own += points
                for k, ancestor in enumerate(way[: -LEVELS - 1 : -1]):
                    self.points[id(ancestor)] = self.points.get(id(ancestor), 0.0) + points / (1 if k == 0 else 2 if k == 1 else 3 * k)
            self.own[id(node)] = own

    def density(self, node: Node) -> float:
        """The share of a block's text that is links."""
        letters = self.letters.get(id(node), 0)
        return self.links[id(node)] / letters if letters else 0.0

    def best(self, root: Node) -> tuple[list[Node], float]:
        """The way from the root to the container with the highest score, and this score."""
        top, found = -1.0, [root]
        above: dict[int, Node] = {}
        stack = [root]
        while stack:
            node = stack.pop()
            score = (self.points.get(id(node), 0.0) + node.weight) * (1 - self.density(node)) if id(node) in self.points else 0.0
            if score > top:
                top, found = score, [node]
            for k in reversed(node.kids):
                if isinstance(k, Node) and id(k) in self.points:
                    above[id(k)] = node
                    stack.append(k)
        while id(found[0]) in above:
            found.insert(0, above[id(found[0])])
        return found, top


def dropped(root: Node) -> set[int]:
    """The blocks (by id) that surround the content: of the siblings of the best container and of its ancestors, those of links or of a page's frame."""
    scores = Scores(root)
    way, top = scores.best(root)
    beside = [k for node, inner in zip(way, way[1:]) for k in node.kids if isinstance(k, Node) and k is not inner and k.tag not in HEADINGS and scores.letters.get(id(k))]
    out = {id(k) for k in beside if scores.density(k) > 0.5}
    if out or any(k.weight < 0 for k in beside):
        out |= {id(k) for k in beside if (scores.own[id(k)] + k.weight) * (1 - scores.density(k)) < SHARE * top}
    return out


# --- output -------------------------------------------------------------------------------------


def elements(source: str | None, whole: bool = False) -> list[tuple[str, str]]:
    """(kind, content) of every heading, list_item, code and formula that is kept, in order, `whole` of all; nothing for null and empty."""
    return [(kind, content) for kind, content, inside in _walk(source)[0] if inside or whole]


def clean_text(source: str | None) -> str | None:
    """The document as text: `#` before headings, `-` before entries, code and formulas fenced; null stays null."""
    return None if source is None else "\n".join(_walk(source)[1])


def _own_text(node: Node) -> str:
    """The text of a block without that of lists, code and tables in it; blocks in it are set off by blanks."""
    out: list[str] = []
    stack: list[str | Node] = [node]
    while stack:
        k = stack.pop()
        if isinstance(k, str):
            out.append(k)
        elif k is node or k.tag == "a":
            stack += k.kids[::-1]
        elif k.tag not in ("ul", "ol", "li", "pre", "table", *HIDDEN):
            stack += [" ", *k.kids[::-1], " "]
    return "".join(out)


_INNER = {"li": {"ul", "ol", "li", "pre", "table"}, "p": {"ul", "ol", "li", "pre", "table", *HEADINGS}} | {h: {"ul", "ol", "pre", "table"} for h in HEADINGS}
_INNER |= {t: _INNER["p"] for t in ("td", "th", "a")}


def _walk(source: str | None) -> tuple[list[tuple[str, str, bool]], list[str]]:
    """(kind, content, whether it is kept) of all elements, and the lines of what is kept."""
    if not source or not source.strip():
        return [], []
    reader = Reader()
    root = reader.read(source)
    gone = dropped(root)
    found: list[tuple[str, str, bool]] = []
    lines: list[str] = []

    def shown(text: str) -> str:
        return _WHITE.sub(" ", _HELD.sub(lambda m: reader.formulas[int(m.group(1))], text)).strip()

    def element(kind: str, content: str, inside: bool) -> None:
        if content:
            found.append((kind, content, inside))

    def text_of(text: str, inside: bool, mark: str = "", kind: str = "") -> None:
        clean = shown(text)
        if kind:
            element(kind, clean, inside)
        if inside and (clean or mark):
            lines.append(mark + clean)
        for m in _HELD.finditer(text):
            element("formula", reader.formulas[int(m.group(1))], inside)

    stack: list[tuple[str | Node, int, bool]] = [(root, 0, True)]
    while stack:
        node, depth, inside = stack.pop()
        if isinstance(node, str):
            if shown(node):
                text_of(node, inside)
            continue
        tag = node.tag
        if tag in HIDDEN:
            continue
        inside = inside and id(node) not in gone
        if tag == "pre":
            code = "".join(k for k in node.kids if isinstance(k, str)).replace("\ue004", "")
            element("code", _WHITE.sub(" ", code).strip(), inside)
            if inside:
                lines.extend(["```", code.strip("\n"), "```"])
            continue
        if tag in _INNER:
            if tag in HEADINGS:
                text_of(_own_text(node), inside, "# ", "heading")
            elif tag == "li":
                text_of(_own_text(node), inside, "  " * depth + "- ", "list_item")
            else:
                text_of(_own_text(node), inside)
            inner = [(k, depth + (tag == "li"), inside) for k in node.kids if isinstance(k, Node) and k.tag in _INNER[tag]]
        else:
            inner = [(k, depth if isinstance(k, str) else depth + (tag in ("ul", "ol") and k.tag in ("ul", "ol")), inside) for k in node.kids]
        stack += inner[::-1]
    return found, lines


def markup_elements(df: DataFrame, key: str = "record_id", field: str = "content_html") -> DataFrame:
    """(key, place, kind, content, kept) for all elements of every row; null, empty and plain texts have none. No shuffle.

    kept: whether it stands in the best container or beside it, and so in the clean text, or in what surrounds it.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, places, kinds, contents, kept = [], [], [], [], []
            for r, source in enumerate(batch.column(1).to_pylist()):
                for place, (k, c, inside) in enumerate(_walk(source)[0], 1):
                    rows.append(r)
                    places.append(place)
                    kinds.append(k)
                    contents.append(c)
                    kept.append(inside)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(places, pa.int32()), pa.array(kinds, pa.string()), pa.array(contents, pa.string()), pa.array(kept, pa.bool_())], [key, "place", "kind", "content", "kept"])

    return df.select(df[f"`{key}`"], df[f"`{field}`"]).mapInArrow(run, f"`{key}` {kind}, place int, kind string, content string, kept boolean")


def markup_texts(df: DataFrame, key: str = "record_id", field: str = "content_html") -> DataFrame:
    """(key, text): the clean text of every row; null where the field is null, empty where nothing is kept."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([clean_text(s) for s in batch.column(1).to_pylist()], pa.string())], [key, "text"])

    return df.select(df[f"`{key}`"], df[f"`{field}`"]).mapInArrow(run, f"`{key}` {kind}, text string")
