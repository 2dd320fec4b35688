"""Visible text of web pages, laid out as a reader sees it.

A tree builder closes and opens the tags that HTML implies. A walk over the tree leaves out what is not visible and writes
blocks on lines of their own, paragraphs apart from each other, list items with their marks and table cells in columns.
"""

from __future__ import annotations

import operator
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliovane.llm.common import as_before, as_text

# Fixed values of HTML: which elements have no end, which are blocks, which close others, which are not shown.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEAD = frozenset("base link meta script style template title noscript".split())
UNSEEN = frozenset(
    "head title script style noscript template iframe object embed audio video canvas svg math datalist area "
    "base link meta param source track colgroup col".split()
)
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl pre blockquote table figure fieldset hr menu".split())
BLOCKS = PARAGRAPHS | frozenset(
    "address article aside body caption center dd details dialog dir div dt figcaption footer form header hgroup html legend "
    "li main nav optgroup option search section summary tr".split()
)
CLOSES_P = (BLOCKS | PARAGRAPHS) - frozenset("body html tr caption option optgroup legend".split())
#: What a start tag closes, and up to which open element it looks.
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"table"}),
    "th": ({"td", "th"}, {"table"}),
    "tr": ({"td", "th", "tr", "caption", "colgroup"}, {"table"}),
    "tbody": ({"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
    "thead": ({"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
} | {f"h{k}": ({f"h{j}" for j in range(1, 7)}, {"td", "th", "li", "div", "section", "article"}) for k in range(1, 7)}
CELLS = frozenset({"td", "th"})

_space = re.compile(r"[ \t\n\r\f]+")
_tag = re.compile(r"<[a-zA-Z/]")
_mark = re.compile(r"[{};]|\Z")
_opaque = re.compile(r"/\*.*?(?:\*/|\Z)|\"(?:\\.|[^\"\\\n])*\"|'(?:\\.|[^'\\\n])*'", re.DOTALL)
_ident = r"-?(?:[^\W\d]|[^\x00-\x7f])[\w-]*|--[\w-]+"
_part = re.compile(
    rf"""\s*(?P<combinator>[>+~])\s*|(?P<blank>\s+)|(?P<tag>{_ident}|\*)|\#(?P<id>[\w-]+)|\.(?P<class>{_ident})
    |\[\s*(?P<name>[\w:-]+)\s*(?:(?P<test>[~|^$*]?=)\s*(?P<value>"[^"]*"|'[^']*'|[^\]\s"']+)\s*(?P<flag>[is])?\s*)?\]
    |(?P<pseudo>::?[\w-]+)(?P<opened>\()?""",
    re.VERBOSE | re.IGNORECASE,
)
_value = re.compile(r"([a-z][a-z -]*?)\s*(!\s*important)?")
_typed = re.compile(r"(?:(not|only)\s+)?([a-z][a-z-]*)(?:\s+and\s+(.+))?", re.DOTALL)
_feature = re.compile(r"\(([^()]*)\)")
_length = r"([0-9]*\.?[0-9]+)(px|em|rem|)"
_limit = re.compile(rf"(min-|max-|)(?:device-)?(width|height)\s*:\s*{_length}")
_range = re.compile(rf"(?:{_length}\s*([<>]=?|=)\s*)?(width|height)(?:\s*([<>]=?|=)\s*{_length})?")

#: What hides an element, by property, and what says that it is as without any rule or as its parent is.
HIDING = {"display": {"none"}, "visibility": {"hidden", "collapse"}}
UNSAID = {"display": {"revert", "revert-layer"}, "visibility": {"inherit", "unset", "revert", "revert-layer"}}
#: What holds for no element of a page that nobody touches.
IDLE = frozenset("hover focus focus-within focus-visible active visited target".split())
#: The screen that media queries are asked for, in pixels, and what else it answers.
SCREEN = {"width": 1280.0, "height": 720.0}
FEATURES = {
    "orientation": "landscape", "hover": "hover", "any-hover": "hover", "pointer": "fine", "any-pointer": "fine",
    "prefers-color-scheme": "light", "prefers-reduced-motion": "no-preference", "scripting": "enabled",
}
COMPARE = {"<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge, "=": operator.eq}


class Node:
    __slots__ = ("tag", "attributes", "children", "parent", "before", "last", "place", "typed", "counts")

    def __init__(self, tag: str, attributes: dict[str, str | None] | None = None) -> None:
        self.tag, self.attributes, self.children = tag, attributes or {}, []
        # The element around it, the one before it, and the last one in it.
        self.parent = self.before = self.last = None
        # Its place among its siblings and those of its tag, from 1, and how many elements of each tag it has.
        self.place = self.typed = 1
        self.counts: dict[str, int] = {}

    def add(self, child: Node) -> None:
        self.children.append(child)
        child.parent, child.before, self.last = self, self.last, child
        if child.before is not None:
            child.place = child.before.place + 1
        child.typed = self.counts[child.tag] = self.counts.get(child.tag, 0) + 1


class TreeBuilder(HTMLParser):
    """Builds the tree; ``open`` counts the open elements so that a search for one that is not open costs nothing."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("#root")
        self.stack = [self.root]
        self.open: Counter[str] = Counter()
        self.styles: list[str] = []

    def _pop(self) -> None:
        self.open[self.stack.pop().tag] -= 1

    def _close(self, tags: set[str], stop: set[str] | frozenset[str]) -> None:
        """Close the outermost open element of ``tags`` that is above the innermost of ``stop``, and all in it."""
        if not any(self.open[tag] for tag in tags):
            return
        depth = None
        for k in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[k].tag
            if tag in tags:
                depth = k
            elif tag in stop:
                break
        while depth is not None and len(self.stack) > depth:
            self._pop()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.open["head"] and tag not in HEAD and tag != "head":
            self._close({"head"}, frozenset())
        if tag in ("html", "body") and self.open[tag]:
            return
        if tag in CLOSES_P:
            self._close({"p"}, CELLS | {"table", "button", "caption"})
        if tag in IMPLIED_END:
            self._close(*IMPLIED_END[tag])
        if tag in CELLS and self.open["table"] and self.stack[-1].tag in ("table", "tbody", "thead", "tfoot"):
            self._push(Node("tr"))
        node = Node(tag, dict(attrs))
        if tag in VOID:
            self.stack[-1].add(node)
        else:
            self._push(node)

    def _push(self, node: Node) -> None:
        self.stack[-1].add(node)
        self.stack.append(node)
        self.open[node.tag] += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        # The slash ends an element only in foreign content; elsewhere it means nothing.
        if tag not in VOID and (self.open["svg"] or self.open["math"]):
            self._pop()

    def handle_endtag(self, tag: str) -> None:
        if tag == "br" or tag == "p" and not self.open["p"]:
            self.stack[-1].add(Node(tag))
        elif self.open[tag] and tag not in ("html", "body"):
            bound = frozenset() if tag in CELLS or tag in ("table", "tr", "tbody", "thead", "tfoot") else CELLS
            for k in range(len(self.stack) - 1, 0, -1):
                if self.stack[k].tag == tag:
                    while len(self.stack) > k:
                        self._pop()
                    break
                if self.stack[k].tag in bound:
                    break

    def handle_data(self, data: str) -> None:
        top = self.stack[-1]
        if top.tag == "style":
            if on_screen(top.attributes.get("media") or ""):
                self.styles.append(data)
        elif self.open["head"] and top.tag == "head":
            if data.strip():
                self._close({"head"}, frozenset())
                self.stack[-1].children.append(data)
        else:
            top.children.append(data)


@dataclass
class Compound:
    """What a selector asks of one element, and how the one that the compound before it asks for is found from there."""

    combinator: str = ""
    tag: str = "*"
    ids: list[str] = field(default_factory=list)
    classes: list[str] = field(default_factory=list)
    tests: list[Callable[[Node], bool]] = field(default_factory=list)
    #: Ids, classes and tags that the tests count as.
    weight: tuple[int, int, int] = (0, 0, 0)

    def holds(self, node: Node) -> bool:
        if self.tag not in ("*", node.tag):
            return False
        attributes = node.attributes
        if self.ids and any(attributes.get("id") != i for i in self.ids):
            return False
        if self.classes and not set(self.classes) <= set((attributes.get("class") or "").split()):
            return False
        return all(test(node) for test in self.tests)

    def specificity(self) -> tuple[int, int, int]:
        a, b, c = self.weight
        return a + len(self.ids), b + len(self.classes), c + (self.tag != "*")




def _attribute_test(name: str, test: str | None, value: str | None, flag: str | None) -> Callable[[Node], bool]:
    name = name.lower()
    wanted = (value or "").strip("\"'") if value and value[0] in "\"'" else value or ""
    fold = (lambda text: text.lower()) if (flag or "").lower() == "i" else (lambda text: text)
    wanted = fold(wanted)
    compare: dict[str | None, Callable[[str], bool]] = {
        None: lambda own: True,
        "=": lambda own: own == wanted,
        "~=": lambda own: wanted in own.split(),
        "|=": lambda own: own == wanted or own.startswith(wanted + "-"),
        "^=": lambda own: wanted != "" and own.startswith(wanted),
        "$=": lambda own: wanted != "" and own.endswith(wanted),
        "*=": lambda own: wanted != "" and wanted in own,
    }
    holds = compare[test]
    return lambda node: name in node.attributes and holds(fold(node.attributes[name] or ""))


def _nth(text: str) -> tuple[int, int] | None:
    """``a, b`` of ``an+b``."""
    text = re.sub(r"\s+", "", text.lower())
    if text in ("odd", "even"):
        return 2, int(text == "odd")
    if found := re.fullmatch(r"([+-]?[0-9]*)n([+-][0-9]+)?", text):
        a = found[1] + "1" if found[1] in ("", "+", "-") else found[1]
        return int(a), int(found[2] or 0)
    return (0, int(text)) if re.fullmatch(r"[+-]?[0-9]+", text) else None


def _pseudo_test(name: str, argument: str | None) -> tuple[Callable[[Node], bool], tuple[int, int, int]] | None:
    """What a pseudo-class asks for, and what it weighs; None where that is not known."""
    one = (0, 1, 0)
    if name in ("is", "where", "not", "matches", "-webkit-any"):
        lists = [selector(text) for text in _split_list(argument or "")]
        if name == "not" and None in lists:
            return None
        known = [one for one in lists if one is not None]
        weight = max((one.specificity() for one in known), default=(0, 0, 0))
        wanted = name != "not"
        return (lambda node: any(one.matches(node) for one in known) == wanted), (0, 0, 0) if name == "where" else weight
    if name in IDLE:
        return (lambda node: False), one
    if name == "root":
        return (lambda node: node.tag == "html"), one
    if name == "empty":
        return (lambda node: not node.children), one
    if name in ("link", "any-link"):
        return (lambda node: node.tag in ("a", "area") and "href" in node.attributes), one
    if name in ("checked", "disabled", "required", "open"):
        return (lambda node: name in node.attributes), one
    if name == "enabled":
        return (lambda node: node.tag in ("input", "button", "select", "textarea") and "disabled" not in node.attributes), one
    found = re.fullmatch(r"(first|last|only|nth|nth-last)-(child|of-type)", name)
    if not found:
        return None
    kind, of_type = found[1], found[2] == "of-type"
    a, b = (0, 1) if argument is None else _nth(argument) or (None, None)
    if a is None or kind.startswith("nth") != (argument is not None):
        return None

    def counted(node: Node) -> bool:
        own = node.typed if of_type else node.place
        last = node.parent.counts[node.tag] if of_type else node.parent.last.place
        places = {"first": [own], "nth": [own], "only": [own, last - own + 1]}.get(kind, [last - own + 1])
        return all(place == b if a == 0 else (place - b) % a == 0 and (place - b) // a >= 0 for place in places)

    return counted, one


def _split_list(text: str) -> list[str]:
    """The selectors of a list, commas in brackets and strings left alone."""
    parts, depth, quote, start = [], 0, "", 0
    for at, char in enumerate(text):
        if quote:
            quote = "" if char == quote else quote
        elif char in "\"'":
            quote = char
        elif char in "([":
            depth += 1
        elif char in ")]":
            depth -= 1
        elif char == "," and depth == 0:
            parts.append(text[start:at])
            start = at + 1
    return [*parts, text[start:]]


def _closing(text: str, at: int) -> int:
    """The end of the bracket that was opened just before ``at``, -1 if it has none."""
    depth, quote = 1, ""
    for k in range(at, len(text)):
        char = text[k]
        if quote:
            quote = "" if char == quote else quote
        elif char in "\"'":
            quote = char
        elif char in "()":
            depth += 1 if char == "(" else -1
            if depth == 0:
                return k
    return -1


class Selector:
    """A selector's compounds, the last one first. It is asked about one page only, and remembers what it found there."""

    def __init__(self, parts: list[Compound]) -> None:
        self.parts = parts
        self.found: dict[tuple[int, int], bool] = {}

    def specificity(self) -> tuple[int, int, int]:
        return tuple(map(sum, zip(*(part.specificity() for part in self.parts), strict=True)))

    def matches(self, node: Node, k: int = 0) -> bool:
        """Whether the compounds from ``k`` on match an element and what is around it."""
        if node.parent is None or not self.parts[k].holds(node):
            return False
        if k + 1 == len(self.parts):
            return True
        combinator = self.parts[k].combinator
        step = "parent" if combinator in " >" else "before"
        other = getattr(node, step)
        if combinator in ">+":
            return other is not None and self.matches(other, k + 1)
        # Some element on the way: what is known of one holds for those further on, so each is asked once.
        way = []
        while other is not None and (k, id(other)) not in self.found:
            way.append(other)
            other = getattr(other, step)
        known = other is not None and self.found[k, id(other)]
        for other in reversed(way):
            known = known or self.matches(other, k + 1)
            self.found[k, id(other)] = known
        return known


#: A selector, and ``property, weight, hides`` of its rule's declarations.
Rule = tuple[Selector, list[tuple[str, tuple, bool | None]]]


def selector(text: str) -> Selector | None:
    """A selector read; None for one that is wrong, of more than 200 compounds, or not known to match anything."""
    text = text.strip()
    parts, at = [Compound()], 0
    fresh = True
    while at < len(text):
        found = _part.match(text, at)
        if not found:
            return None
        at = found.end()
        here = parts[0]
        if found["combinator"] or found["blank"]:
            if fresh:
                return None
            parts.insert(0, Compound((found["combinator"] or " ").strip() or " "))
            fresh = True
            continue
        if found["tag"]:
            if not fresh:
                return None
            here.tag = found["tag"].lower()
        elif found["id"]:
            here.ids.append(found["id"])
        elif found["class"]:
            here.classes.append(found["class"])
        elif found["name"]:
            here.tests.append(_attribute_test(found["name"], found["test"], found["value"], found["flag"]))
            here.weight = tuple(map(sum, zip(here.weight, (0, 1, 0), strict=True)))
        else:
            argument = None
            if found["opened"]:
                end = _closing(text, at)
                if end < 0:
                    return None
                argument, at = text[at:end], end + 1
            known = None if found["pseudo"].startswith("::") else _pseudo_test(found["pseudo"][1:].lower(), argument)
            if known is None:
                return None
            here.tests.append(known[0])
            here.weight = tuple(map(sum, zip(here.weight, known[1], strict=True)))
        fresh = False
    return None if fresh or len(parts) > 200 else Selector(parts)


def _not(value: bool | None) -> bool | None:
    return None if value is None else not value


def _pixels(number: str, unit: str) -> float:
    return float(number) * (16 if unit in ("em", "rem") else 1)


def _has_feature(text: str) -> bool | None:
    """Whether the screen has a media feature; None where that is not known."""
    text = text.strip()
    if found := _limit.fullmatch(text):
        size = _pixels(found[3], found[4])
        return COMPARE[{"min-": ">=", "max-": "<=", "": "="}[found[1]]](SCREEN[found[2]], size)
    if (found := _range.fullmatch(text)) and (found[3] or found[5]):
        own = SCREEN[found[4]]
        left = not found[3] or COMPARE[found[3]](_pixels(found[1], found[2]), own)
        return left and (not found[5] or COMPARE[found[5]](own, _pixels(found[6], found[7])))
    name, _, value = map(str.strip, text.partition(":"))
    if name in FEATURES:
        return value in ("", FEATURES[name])
    return None


def _holds(condition: str) -> bool | None:
    values = [_has_feature(text) for text in _feature.findall(condition)]
    shape = _feature.sub("#", condition).split()
    if shape == ["not", "#"]:
        return _not(values[0])
    if shape[::2] == ["#"] * len(values) and len(shape) == 2 * len(values) - 1:
        if set(shape[1::2]) <= {"and"}:
            return False if False in values else None if None in values else True
        if set(shape[1::2]) == {"or"}:
            return True if True in values else None if None in values else False
    return None


def on_screen(media: str) -> bool:
    """Whether a list of media queries is known to apply to the screen."""

    def applies(query: str) -> bool | None:
        if not (found := _typed.fullmatch(query)):
            return _holds(query)
        value = found[2] in ("all", "screen") and (found[3] is None or _holds(found[3]))
        return _not(value) if found[1] == "not" else value

    media = media.strip().lower()
    return not media or any(applies(query.strip()) for query in media.split(","))


def _applies(prelude: str) -> bool:
    """Whether the rules in the block of an at-rule hold: those of frames, fonts, pages and containers do not."""
    name, rest = re.match(r"@([\w-]*)(.*)", prelude.lower(), re.DOTALL).groups()
    if name == "media":
        return on_screen(rest)
    return name == "layer" or name == "supports" and not rest.strip().startswith("not")


def style_rules(style: str) -> Iterator[tuple[str, list[str]]]:
    """Selectors and declarations of a style sheet's rules for a screen; what is open at its end ends there."""
    strings: list[str] = []

    def put_by(found: re.Match) -> str:
        if found[0][0] == "/":
            return ""
        strings.append(found[0])
        return f'"{len(strings) - 1}"'

    def restored(text: str) -> str:
        return re.sub(r'"([0-9]+)"', lambda m: strings[int(m[1])], text)

    # Strings are put by, so that nothing in them is taken for a mark.
    style = _opaque.sub(put_by, style)
    # An open block: the selectors of a rule, True for a group whose rules hold, None for what is left out.
    blocks: list[str | bool | None] = [True]
    declarations: list[str] = []
    start, broken = 0, False
    for found in _mark.finditer(style):
        text, mark, start, top = style[start : found.start()].strip(), found[0], found.end(), blocks[-1]
        if mark == "{":
            if top is not True or broken:
                blocks.append(None)
            elif text.startswith("@"):
                blocks.append(_applies(text) or None)
            else:
                blocks.append(text)
                declarations = []
            broken = False
            continue
        if isinstance(top, str):
            declarations.append(text)
            if mark != ";":
                yield restored(top), declarations
        elif not mark and (rule := next((b for b in blocks if isinstance(b, str)), None)) is not None:
            yield restored(rule), declarations
        elif mark == ";":
            broken = top is True and (broken or not text.startswith("@"))
        if mark == "}":
            broken = False
            if len(blocks) > 1:
                blocks.pop()


def _shown(declarations: list[str]) -> dict[str, tuple[bool, bool | None]]:
    """``important, hides`` of what the declarations say last about each property of ``HIDING``; None for nothing of its own."""
    said: dict[str, tuple[bool, bool | None]] = {}
    for declaration in declarations:
        name, _, value = declaration.lower().partition(":")
        name = name.strip()
        if name in HIDING and (found := _value.fullmatch(value.strip())):
            important = found[2] is not None
            if important or not said.get(name, (False,))[0]:
                said[name] = important, None if found[1] in UNSAID[name] else found[1] in HIDING[name]
    return said


def hiding_rules(styles: list[str]) -> dict[str, list[Rule]]:
    """The rules that say whether what they match is shown, by an id, class or tag that they ask of it.

    A weight orders declarations as style sheets do: important ones, then by ids, classes and tags, then the later one.
    """
    rules: dict[str, list[Rule]] = {}
    order = 0
    for style in styles:
        for selectors, declarations in style_rules(style):
            order += 1
            if not (said := _shown(declarations)):
                continue
            for one in map(selector, _split_list(selectors)):
                if one is None:
                    continue
                rank, last = (0, *one.specificity(), order), one.parts[0]
                said_by = [(name, (important, *rank), hides) for name, (important, hides) in said.items()]
                names = [*("#" + i for i in last.ids), *("." + c for c in last.classes), last.tag]
                rules.setdefault(names[0], []).append((one, said_by))
    return rules


def said_of(node: Node, rules: dict[str, list[Rule]]) -> dict[str, bool | None]:
    """Whether the page's styles hide an element, by property, where they say so."""
    attributes = node.attributes
    style = attributes.get("style")
    if not rules and not style:
        return {}
    won: dict[str, tuple[tuple, bool | None]] = {}
    if style:
        for name, (important, hides) in _shown(_opaque.sub("", style).split(";")).items():
            won[name] = (important, 1, 0, 0, 0, 0), hides
    if rules:
        classes = set((attributes.get("class") or "").split())
        for key in ("*", node.tag, *("." + c for c in classes), f"#{attributes.get('id')}"):
            for one, said in rules.get(key, ()):
                if one.matches(node):
                    for name, weight, hides in said:
                        if name not in won or won[name][0] < weight:
                            won[name] = weight, hides
    return {name: hides for name, (_, hides) in won.items()}


def hidden(node: Node, rules: dict[str, list[Rule]], inherited: bool = False) -> bool | None:
    """Whether an element's own text is invisible; None if neither it nor anything in it is shown.

    What is in an invisible element may be visible; what is in one that is not displayed is not.
    """
    attributes = node.attributes
    if node.tag in UNSEEN or node.tag == "input" and (attributes.get("type") or "").lower() == "hidden":
        return None
    said = said_of(node, rules)
    gone = said.get("display")
    if gone is None:
        # Without a word from the page's styles these are not displayed.
        gone = "hidden" in attributes or node.tag == "dialog" and "open" not in attributes
    own = said.get("visibility")
    return None if gone else inherited if own is None else own


class Frame:
    """Lines being written: the page's own, or those of one table cell."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = False
        self.gap = 0
        self.indents: list[str] = []
        self.mark = ""

    def text(self, text: str, preserved: bool) -> None:
        if preserved:
            first, *rest = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
            self._add(first)
            for line in rest:
                self.end_line(keep=True)
                self._add(line)
            return
        words = _space.sub(" ", text)
        if words.startswith(" "):
            self.space = True
        words = words.strip(" ")
        if words:
            self._add((" " if self.space and self.line else "") + words)
            self.space = text[-1] in " \t\n\r\f"

    def _add(self, text: str) -> None:
        if text:
            if not self.line:
                self._start()
            self.line.append(text)

    def _start(self) -> None:
        if self.lines:
            self.lines += [""] * (self.gap - 1)
        self.gap = 0

    def end_line(self, keep: bool = False) -> None:
        """Finish the line; an empty one counts only where line breaks are kept."""
        if self.line or keep:
            if not self.line:
                self._start()
            indent = "".join(self.indents)
            if self.mark:
                indent, self.mark = indent[: -len(self.mark)] + self.mark, ""
            self.lines.append((indent + "".join(self.line)).rstrip(" "))
            self.line = []
        self.space = False

    def block(self, gap: int) -> None:
        """The next text starts a line of its own, ``gap - 1`` empty lines below the last."""
        self.end_line()
        self.gap = max(self.gap, gap)

    def item(self, mark: str) -> None:
        self.end_line()
        self.indents.append(" " * len(mark))
        self.mark = mark

    def end_item(self) -> None:
        if self.mark:
            self._add("")
            self.end_line(keep=True)
        self.end_line()
        self.indents.pop()

    def put(self, lines: list[str]) -> None:
        """Lines laid out already."""
        for line in lines:
            self.line = [line] if line else []
            if line:
                self._start()
            self.end_line(keep=True)

    def finish(self) -> list[str]:
        self.end_line()
        return self.lines


def _span(node: Node, name: str) -> int:
    value = node.attributes.get(name) or ""
    return min(max(int(value), 1), 100) if value.isascii() and value.isdigit() else 1


def aligned(rows: list[list[tuple[list[str], int, int]]]) -> list[str]:
    """Lines of a table from its cells ``(lines, columns, rows)``: columns start below each other, two spaces apart."""
    placed: list[list[tuple[int, int, list[str]]]] = []
    held: dict[int, int] = {}
    widths: dict[int, int] = {}
    for cells in rows:
        row, at = [], 0
        blocked = {c for c, left in held.items() if left > 0}
        held = {c: left - 1 for c, left in held.items() if left > 1}
        for lines, columns, deep in cells:
            while at in blocked:
                at += 1
            row.append((at, columns, lines))
            if deep > 1:
                held.update({c: deep - 1 for c in range(at, at + columns)})
            if columns == 1:
                widths[at] = max(widths.get(at, 0), max(map(len, lines), default=0))
            at += columns
        placed.append(row)
    for row in placed:
        for at, columns, lines in row:
            if columns > 1:
                inner = sum(widths.get(c, 0) + 2 for c in range(at, at + columns)) - 2
                last = at + columns - 1
                widths[last] = widths.get(last, 0) + max(0, max(map(len, lines), default=0) - inner)
    starts, x = {}, 0
    for c in range(max(widths, default=-1) + 1):
        starts[c] = x
        x += widths[c] + 2 if widths.get(c) else 0
    out = []
    for row in placed:
        for k in range(max((len(lines) for _, _, lines in row), default=0)):
            line = ""
            for at, _, lines in row:
                if k < len(lines):
                    line = line.ljust(starts.get(at, 0)) + lines[k]
            out.append(line.rstrip(" "))
    return out


class Renderer:
    """Walks a tree with a stack of its own, so that depth is no limit."""

    def __init__(self, builder: TreeBuilder) -> None:
        self.rules = hiding_rules(builder.styles)
        self.frames = [Frame()]
        self.tables: list[list[list[tuple[list[str], int, int]]]] = []
        self.lists: list[int | None] = []
        self.preserved = 0
        self._walk(builder.root)

    def _walk(self, root: Node) -> None:
        # What is to do with a node: write or enter it, or leave it; and whether the text around it is invisible.
        todo: list[tuple[Node | str, bool, bool]] = [(root, False, False)]
        while todo:
            node, left, unseen = todo.pop()
            if isinstance(node, str):
                if not unseen:
                    self.frames[-1].text(node, self.preserved > 0)
            elif left:
                self._leave(node, unseen)
            elif (unseen := hidden(node, self.rules, unseen)) is not None:
                if self._enter(node, unseen):
                    todo.append((node, True, unseen))
                    children = node.children
                    if node.tag == "details" and "open" not in node.attributes:
                        children = [c for c in children if isinstance(c, Node) and c.tag == "summary"]
                    todo += [(child, False, unseen) for child in reversed(children)]

    def _enter(self, node: Node, unseen: bool) -> bool:
        """Begin an element; an invisible one takes its place, but has no text, mark or quotes of its own."""
        tag, frame = node.tag, self.frames[-1]
        if unseen and tag in ("br", "input", "img"):
            return False
        if tag == "br":
            frame.end_line(keep=bool(frame.lines))
            return False
        if tag == "input":
            value = node.attributes.get("value")
            if value and (node.attributes.get("type") or "text").lower() not in ("checkbox", "radio", "password", "image"):
                frame.text(f" {value} ", False)
            return False
        if tag == "img":
            frame.text(f" {node.attributes.get('alt') or ''} ", False)
            return False
        if tag in CELLS and self.tables:
            self.frames.append(Frame())
            return True
        if tag == "tr" and self.tables:
            self.tables[-1].append([])
            return True
        if tag in BLOCKS:
            nested = tag in ("ul", "ol", "menu") and self.lists
            frame.block(2 if tag in PARAGRAPHS and not nested else 1)
        if tag == "table":
            self.tables.append([])
        elif tag in ("ul", "ol", "menu", "dir"):
            start = node.attributes.get("start") or ""
            first = int(start) if re.fullmatch(r"-?[0-9]{1,9}", start) else 1
            self.lists.append(first if tag == "ol" else None)
        elif tag == "li":
            number = self.lists[-1] if self.lists else None
            if number is not None:
                self.lists[-1] = number + 1
            frame.item("" if unseen else "- " if number is None else f"{number}. ")
        elif tag in ("dd", "blockquote"):
            frame.indents.append("  ")
        elif tag in ("pre", "textarea", "listing"):
            self.preserved += 1
            if node.children and isinstance(node.children[0], str):
                node.children[0] = node.children[0].removeprefix("\n")
        elif tag == "q" and not unseen:
            frame.text('"', True)
        return True

    def _leave(self, node: Node, unseen: bool) -> None:
        tag, frame = node.tag, self.frames[-1]
        if tag in CELLS and self.tables:
            lines = self.frames.pop().finish()
            if not self.tables[-1]:
                self.tables[-1].append([])
            self.tables[-1][-1].append((lines, _span(node, "colspan"), _span(node, "rowspan")))
            return
        if tag == "tr" and self.tables:
            return
        if tag == "table":
            frame.block(1)
            frame.put(aligned(self.tables.pop()))
        elif tag in ("ul", "ol", "menu", "dir"):
            self.lists.pop()
        elif tag == "li":
            frame.end_item()
        elif tag in ("dd", "blockquote"):
            frame.end_line()
            frame.indents.pop()
        elif tag in ("pre", "textarea", "listing"):
            self.preserved -= 1
        elif tag == "q" and not unseen:
            frame.text('"', True)
        if tag in BLOCKS:
            nested = tag in ("ul", "ol", "menu") and self.lists
            frame.block(2 if tag in PARAGRAPHS and not nested else 1)

    def result(self) -> str:
        return "\n".join(self.frames[0].finish())


def render(html: str | None) -> str:
    """The visible text of a page."""
    html = html or ""
    # A tag that the page breaks off in is no text.
    if cut := _tag.search(html, html.rfind(">") + 1):
        html = html[: cut.start()]
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    return Renderer(builder).result()


def page_texts(pages: DataFrame, id_column: str = "page_id", html_column: str = "html") -> DataFrame:
    """``page_id, text`` for every row: its visible text, whole.

    Broken markup is read as far as it goes. Null and empty pages give an empty text. Repeated rows are alike, a null id stays
    null, an empty table gives an empty result, other columns are ignored. Nothing is shuffled; a task holds one batch of
    pages and the tree of one.
    """
    narrow = pages.select(as_text(id_column, "page_id"), F.col(html_column).alias("html"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"page_id": batch["page_id"], "text": [render(html) for html in batch["html"]]})

    texts = narrow.mapInPandas(run, "page_id string, text string")
    return as_before(texts, "page_id", dict(pages.dtypes)[id_column])
