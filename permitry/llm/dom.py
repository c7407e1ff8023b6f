"""A forgiving HTML tree of tags, labels and texts; what a browser repairs without harm is repaired here."""

import html
import re

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_LABEL = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not markup.
_RAW = {tag: re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I) for tag in ("script", "style", "textarea", "title", "noscript", "iframe")}
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody tfoot thead
    tr ul""".split())
#: Open elements that a start tag closes, and the elements beyond which it does not look.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}), "body": ({"head"}, set()),
}
_IN_P = BLOCKS - {"body", "html", "tr", "td", "th", "tbody", "thead", "tfoot", "caption", "summary", "li", "dd", "dt"}


#: Elements nested deeper than this become neighbours, as in browsers, so that a page cannot exhaust the stack.
DEEPEST = 250


class Node:
    """An element: tag, words of its class, id and role, and its texts and elements in order."""

    __slots__ = ("tag", "label", "parts", "fixed")

    def __init__(self, tag, label=""):
        self.tag, self.label, self.parts, self.fixed = tag, label, [], False

    def elements(self):
        return [part for part in self.parts if part.__class__ is Node]


def _close(stack, wanted, beyond):
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag in wanted:
            del stack[k:]
            return
        if stack[k].tag in beyond:
            return


def parse(text):
    """The root node of an HTML text; character references are decoded."""
    root = Node("#root")
    stack, at, n = [root], 0, len(text)
    while at < n:
        found = _TOKEN.search(text, at)
        if found is None:
            stack[-1].parts.append(html.unescape(text[at:]))
            break
        if found.start() > at:
            plain = text[at:found.start()]
            stack[-1].parts.append(html.unescape(plain) if "&" in plain else plain)
        at = found.end()
        closing, tag, more = found.group(1, 2, 3) if found.group(2) else found.group(4, 5, 6)
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                if tag not in BLOCKS and stack[k].tag in BLOCKS:
                    break
            continue
        if tag in _VOID:
            stack[-1].parts.append(Node(tag) if tag == "hr" else " " if tag == "br" else "")
            continue
        if tag in _IN_P:
            _close(stack, {"p"}, {"button", "td", "th", "li", "dd", "object"})
        if tag in _CLOSES:
            _close(stack, *_CLOSES[tag])
        label = " ".join(a or b or c for a, b, c in _LABEL.findall(more)).lower() if more else ""
        node = Node(tag, label)
        stack[-1].parts.append(node)
        if tag in _RAW:
            end = _RAW[tag].search(text, at)
            at = end.end() if end else n
        elif not more.endswith("/") and len(stack) < DEEPEST:
            stack.append(node)
    return root
