"""Main text of web pages by wrapper induction.

1. Each page becomes a tree; neighbouring elements of equal tag and label are folded into one, so lists and paragraphs
   of any number are one node.
2. Pages of a host are aligned by simple tree matching: two nodes of equal tag and label match, and their children are
   aligned in order so that most nodes match. A task merges its pages host by host into a template; templates of tasks
   are merged in two rounds, so that a host with a third of all pages is never gathered as pages. A template node counts
   its pages and votes (Boyer-Moore) for its text. A second pass aligns every page with the finished template of its
   host and counts exactly each node's pages and those that have the winning text.
3. A node whose text wins the vote on nearly all pages of at least ``FEW`` is constant and belongs to the template; the
   others are slots. Every page is aligned with its host's template, and its constant nodes are left out.
4. Slots that are menus, headers, footers, sidebars, notices, adverts, forms or comments by tag or label are left out, and
   so are slots of links, the innermost first, so that a wrapper around menus and an article keeps the article. A node
   that holds most of the page's text outside links is never left out by label or links; so comments stay if they are
   longer than all else. If the page marks its article or main part, only that is taken. If nothing is left, constant
   nodes stay (pages that repeat one article); if still nothing is, labels are not looked at.

Text is taken by blocks in page order; character references are decoded, white space inside a block becomes one space,
blocks are joined by an empty line.

Defined cases: NULL and empty pages give an empty text; a NULL or odd address counts as host ''; repeated rows get equal
results; NULL ids are returned as they are; an empty table gives an empty result. Columns other than id, address and
html are not looked at.
"""

import json
import re
from functools import partial

import pyarrow as pa
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from permitry.llm.dom import BLOCKS, Node, parse
from permitry.llm.slices import slices
from permitry.session import written

#: A host needs so many pages for a template; a node is constant if its text has at least this share of them.
FEW = 5
CONSTANT = 0.8
#: Part of the template is only what at least one in ``RARE`` pages with its parent has. A node of more than ``WIDEST``
#: children forgets those that are twice as rare, so its size is bounded by that of the pages, not by their number.
RARE = 100
WIDEST = 200
HOSTS_HELD = 2000
TASK_TEMPLATES = 2000
SALTS = 64
_SKIPPED = frozenset("""script style noscript template iframe svg math canvas audio video object embed head title nav
    footer aside form button select textarea input label menu dialog fieldset""".split())
_LANDMARKS = frozenset(("article", "main"))
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: Blocks that are left out if most of their letters are in links.
_LISTS = frozenset(("ul", "ol", "div", "table"))
_CAPTIONS = _HEADINGS - {"h1"}
_NAMES = (
    r"(?:nav(?:bar|igation)?|menus?|breadcrumbs?|(?:site|page|top)?header|masthead|banner|(?:site|page)?footer|"
    r"(?:side|left|right)bar|sidebars?|aside|widgets?|related|recommend(?:ed|ations)?|trending|share|sharing|social|promos?|"
    r"ads?|advert(?:s|isement|isements|ising)?|sponsor(?:s|ed)?|cookies?|consent|notices?|gdpr|popup|modal|overlay|"
    r"newsletter|subscribe|subscription|signup|login|search|comments?|commentlist|disqus|respond|replies|reply|"
    r"pagination|pager|copyright|legal|skip|toolbar|contentinfo|complementary|alert)")
_BOILERPLATE = re.compile(rf"(?:^|[^a-z0-9]){_NAMES}(?![a-z0-9])")
#: A whole word of the label names the part; a word inside another ("left-sidebar-layout") may describe a wrapper.
_NAMED = re.compile(rf"(?:^|\s){_NAMES}(?!\S)")
#: Words that say what a wrapper is laid out with, or name a page's own content.
_LAYOUT = re.compile(r"(?<![a-z0-9])(?:(?:no|with|without|has)[-_]+[^\s]+|search[-_]?results?(?![a-z0-9]))")
#: Elements of an article's own text; other constant elements inside it belong to the template.
_PROSE = frozenset("article main p h1 h2 h3 h4 h5 h6 li td th dd dt blockquote pre b i em strong a code q cite sub sup".split())
_BLANK = re.compile(r"[0-9]+")


def _key(node):
    return f"{node.tag} {_BLANK.sub('0', node.label)}"


class Folded:
    """Neighbouring elements of equal key as one node of a page, or a node of a template."""

    __slots__ = ("key", "nodes", "children", "pages", "vote", "votes")

    def __init__(self, key, nodes=(), pages=1, vote=0, votes=1):
        self.key, self.nodes, self.children, self.pages, self.vote, self.votes = key, nodes, [], pages, vote, votes


def fold(nodes):
    """The folded tree of some elements of equal key."""
    folded = Folded(_key(nodes[0]), nodes)
    text, runs = [], []
    for node in nodes:
        for part in node.parts:
            if part.__class__ is Node:
                key = _key(part)
                if runs and runs[-1][0] == key:
                    runs[-1][1].append(part)
                else:
                    runs.append((key, [part]))
            elif part and not part.isspace():
                text.append(" ".join(part.split()))
    folded.vote = xxhash.xxh32_intdigest(" ".join(text)) if text else 0
    folded.children = [fold(run) for _, run in runs]
    return folded


def _matched(a, b):
    """Simple tree matching: how many nodes match, and which children do, as (i, j, their own match)."""
    m, n = len(a.children), len(b.children)
    if not m or not n:
        return 1, ()
    found = {}
    best = [[0] * (n + 1) for _ in range(m + 1)]
    for i, own in enumerate(a.children):
        row, above = best[i + 1], best[i]
        for j, other in enumerate(b.children):
            most = above[j + 1] if above[j + 1] >= row[j] else row[j]
            if own.key == other.key:
                pair = found[i, j] = _matched(own, other)
                if above[j] + pair[0] > most:
                    most = above[j] + pair[0]
            row[j + 1] = most
    pairs, i, j = [], m, n
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((i, j, found[i, j]))
    return best[m][n] + 1, pairs[::-1]


def _merge(template, other, match=None):
    """Add the pages of ``other`` to ``template``; roots have equal keys."""
    _, pairs = match or _matched(template, other)
    template.pages += other.pages
    if template.vote == other.vote:
        template.votes += other.votes
    elif template.votes >= other.votes:
        template.votes -= other.votes
    else:
        template.vote, template.votes = other.vote, other.votes - template.votes
    children, i, j = [], 0, 0
    for own, theirs, below in [*pairs, (len(template.children), len(other.children), None)]:
        children += template.children[i:own]
        children += other.children[j:theirs]
        if below:
            _merge(template.children[own], other.children[theirs], below)
            children.append(template.children[own])
        i, j = own + 1, theirs + 1
    if len(children) > WIDEST:
        children = [c for c in children if 2 * RARE * c.pages >= template.pages]
    template.children = children


def _dump(node):
    return [node.key, node.pages, node.vote, node.votes, [_dump(c) for c in node.children]]


def _load(data):
    node = Folded(data[0], (), data[1], data[2], data[3])
    node.children = [_load(c) for c in data[4]]
    return node


def host_of(address):
    """Host of an address column; '' if it has none."""
    return F.coalesce(F.lower(F.regexp_extract(F.coalesce(address, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


_TEMPLATE = "host string, template string"
_COUNTS = "host string, node int, pages bigint, votes bigint"


def _templates(rows):
    return pa.RecordBatch.from_arrays(
        [pa.array([h for h, _ in rows], pa.string()), pa.array([json.dumps(_dump(t)) for _, t in rows], pa.string())],
        ["host", "template"])


def _page_templates(batches):
    held = {}
    for batch in batches:
        for host, text in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            tree = fold([parse(text or "")])
            if host in held:
                _merge(held[host], tree)
            else:
                held[host] = tree
            if len(held) > HOSTS_HELD:
                yield _templates(held.items())
                held = {}
    if held:
        yield _templates(held.items())


def _merged_templates(table):
    merged = {}
    for host, text in zip(table.column("host").to_pylist(), table.column("template").to_pylist()):
        tree = _load(json.loads(text))
        if host in merged:
            _merge(merged[host], tree)
        else:
            merged[host] = tree
    return pa.Table.from_batches([_templates(merged.items())])


def _preorder(node):
    yield node
    for child in node.children:
        yield from _preorder(child)


def _count(page, template, match=None):
    """Count a page at the nodes of its host's template."""
    _, pairs = match or _matched(page, template)
    template.pages += 1
    template.votes += page.vote == template.vote
    for i, j, below in pairs:
        _count(page.children[i], template.children[j], below)


def _counts(held):
    rows = [(host, i, node.pages, node.votes) for host, root in held.items() for i, node in enumerate(_preorder(root)) if node.pages]
    types = pa.string(), pa.int32(), pa.int64(), pa.int64()
    return pa.RecordBatch.from_arrays(
        [pa.array(values, kind) for values, kind in zip(zip(*rows), types)], ["host", "node", "pages", "votes"])


def _page_counts(batches):
    held = {}
    for batch in batches:
        for host, text, template in zip(*(batch.column(name).to_pylist() for name in ("host", "html", "template"))):
            if host not in held:
                if len(held) >= HOSTS_HELD:
                    yield _counts(held)
                    held = {}
                held[host] = _load(json.loads(template))
                for node in _preorder(held[host]):
                    node.pages = node.votes = 0
            _count(fold([parse(text or "")]), held[host])
    if held:
        yield _counts(held)


def _with_counts(batches):
    for batch in batches:
        done = []
        for host, template, counts in zip(*(batch.column(name).to_pylist() for name in ("host", "template", "counts"))):
            root, known = _load(json.loads(template)), {c["node"]: c for c in counts}
            for i, node in enumerate(_preorder(root)):
                node.pages, node.votes = (known[i]["pages"], known[i]["votes"]) if i in known else (0, 0)
            done.append((host, root))
        yield _templates(done)


def _counted(rows, merged):
    """The templates with exact counts of pages and votes."""
    counts = rows.join(merged, "host").select("host", "html", "template").mapInArrow(_page_counts, _COUNTS)
    each = counts.groupBy("host", "node").agg(F.sum("pages").alias("pages"), F.sum("votes").alias("votes"))
    of_host = each.groupBy("host").agg(F.collect_list(F.struct("node", "pages", "votes")).alias("counts"))
    return merged.join(of_host, "host").mapInArrow(_with_counts, _TEMPLATE)


def templates(pages, address_column="url", html_column="html"):
    """Rows (host, template), one for each host, from all pages."""
    rows = pages.select(host_of(F.col(address_column)).alias("host"), F.col(html_column).cast("string").alias("html"))
    found = rows.mapInArrow(_page_templates, _TEMPLATE).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    bucket = F.pmod(F.xxhash64("host", "salt"), F.lit(TASK_TEMPLATES)).cast("int")
    once = found.groupBy(bucket.alias("bucket")).applyInArrow(_merged_templates, _TEMPLATE)
    bucket = F.pmod(F.xxhash64("host"), F.lit(TASK_TEMPLATES)).cast("int")
    merged = written(once.groupBy(bucket.alias("bucket")).applyInArrow(_merged_templates, _TEMPLATE))
    return written(_counted(rows, merged))


def _fix(page, template, match=None, parent_pages=0):
    """Mark the page's nodes that are constant on its host."""
    _, pairs = match or _matched(page, template)
    common = template.pages >= FEW and RARE * template.pages >= parent_pages
    if common and template.vote and template.vote == page.vote and template.votes >= CONSTANT * template.pages:
        for node in page.nodes:
            node.fixed = True
    for i, j, below in pairs:
        _fix(page.children[i], template.children[j], below, template.pages)


def _boilerplate(node, names=_BOILERPLATE):
    return bool(node.label) and node.tag not in ("body", "html") and bool(names.search(_LAYOUT.sub("", node.label)))


def _has_landmark(node):
    return any(part.tag in _LANDMARKS or _has_landmark(part) for part in node.elements())


def _is_landmark(node):
    return node.tag in _LANDMARKS or node.label == "main" or node.label.endswith(" main")


def _dense(left):
    """Whether links are most of what is left of a block, or only a caption is left beside its links."""
    prose, captions, links, gone = left
    return links > prose + captions or (not prose and gone > captions > 0)


class _Pass:
    """One try at a page: which texts count, how much text each node holds, and which nodes are left out."""

    def __init__(self, root, drop_fixed, by_label):
        self.drop_fixed, self.by_label, self.sizes, self.alike = drop_fixed, by_label, {}, {}
        self.left, self.gone = {}, set()
        self._measure(root, False, False, False)
        self.whole = self.sizes[root]
        self.marked = self._landmarks(root, [])
        self.inside = bool(self.marked)
        if self.inside:
            self.whole = tuple(map(sum, zip(*(self.sizes[part] for part in self.marked))))
        for part in self.marked or [root]:
            self._sift(part, False, False)

    def _texts(self, node, inside):
        return not (self.drop_fixed and node.fixed and not (inside and node.tag in _PROSE))

    def _measure(self, node, inside, link, named):
        """Letters of a node outside links, and those of them that are in no part named as boilerplate."""
        prose, plain, alike = 0, 0, {}
        counts = not link and self._texts(node, inside)
        for part in node.parts:
            if part.__class__ is Node:
                if part.tag in _SKIPPED:
                    continue
                own = self._measure(
                    part, inside or _is_landmark(part), link or part.tag == "a", named or _boilerplate(part, _NAMED))
                if part.tag != "header" or inside:
                    prose, plain = prose + own[0], plain + own[1]
                if part.label:
                    alike.setdefault(_key(part), []).append(part)
            elif counts:
                found = _letters(part)
                prose, plain = prose + found, plain + (0 if named else found)
        for parts in alike.values():
            if len(parts) > 1:
                together = tuple(map(sum, zip(*(self.sizes[part] for part in parts))))
                self.alike.update(dict.fromkeys(parts, together))
        self.sizes[node] = prose, plain
        return prose, plain

    def _most(self, node):
        """Whether a node and its siblings of equal key hold most of the text outside links.

        Named parts do not count against a mere wrapper.
        """
        prose, plain = self.alike.get(node) or self.sizes[node]
        return 2 * prose > self.whole[0] or (2 * plain > self.whole[1] and not _boilerplate(node, _NAMED))

    def _landmarks(self, node, found):
        """Outermost articles and main parts that are not boilerplate by label."""
        for part in node.elements():
            if part.tag in _SKIPPED or (part.tag in _LANDMARKS and self.by_label and _boilerplate(part) and not self._most(part)):
                continue
            if _is_landmark(part):
                found.append(part)
            else:
                self._landmarks(part, found)
        return found

    def _left_out(self, node):
        if node.tag in _SKIPPED:
            return True
        if node.tag == "header":
            return not self.inside
        return self.by_label and _boilerplate(node) and (self.inside or not _has_landmark(node)) and not self._most(node)

    def _sift(self, node, link, caption):
        """Leave out what is innermost first; letters left as prose, in captions and in links, and of links left out."""
        left, counts = [0, 0, 0, 0], self._texts(node, self.inside)
        for part in node.parts:
            if part.__class__ is not Node:
                if counts:
                    left[2 if link else 1 if caption else 0] += _letters(part)
                continue
            if self._left_out(part):
                self.gone.add(part)
                continue
            own = self._sift(part, link or part.tag == "a", caption or part.tag in _CAPTIONS)
            if part.tag in _LISTS and not self.inside and not _has_landmark(part) and _dense(own):
                if self._most(part):
                    self._thin(part)
                else:
                    self.gone.add(part)
                    own = 0, 0, 0, own[2] + own[3]
            self.left[part] = own
            left = [a + b for a, b in zip(left, own)]
        return left

    def _thin(self, node):
        """Leave out the blocks of links in a node that stays for its text."""
        for part in node.elements():
            if part in self.gone:
                continue
            if part.tag in BLOCKS and part.tag not in _HEADINGS and _dense(self.left[part]) and not self._most(part):
                self.gone.add(part)
            else:
                self._thin(part)


def _letters(text):
    """Characters of the words of a text; lone marks between links are none."""
    return sum(len(word) for word in text.split() if len(word) > 1 or word.isalnum())


def _blocks(node, found, out):
    """Append the pieces of text of a node to ``out``; None stands for a block's edge."""
    texts = found._texts(node, found.inside)
    for part in node.parts:
        if part.__class__ is not Node:
            if texts:
                out.append(part)
            continue
        edge = part.tag in BLOCKS
        if part in found.gone:
            out.append(None if edge else " ")
            continue
        out.append(None if edge else " " if part.tag in ("td", "th") else "")
        _blocks(part, found, out)
        if edge:
            out.append(None)


def _joined(out):
    texts, held = [], []
    for piece in [*out, None]:
        if piece is None:
            block = " ".join("".join(held).split())
            if block:
                texts.append(block)
            held = []
        else:
            held.append(piece)
    return "\n\n".join(texts)


def main_text(text, template=None):
    """The article of one page; ``template`` is that of its host."""
    root = parse(text)
    if template is not None:
        _fix(fold([root]), template)
    for by_label, drop_fixed in ((True, True), (True, False), (False, True), (False, False)):
        kept = _Pass(root, drop_fixed, by_label)
        out = []
        for part in kept.marked or [root]:
            out.append(None)
            _blocks(part, kept, out)
            out.append(None)
        found = _joined(out)
        if found:
            break
    return found


def _extract(batches, schema):
    known = {}
    for whole in batches:
        for batch in slices(whole, 2):
            texts, addresses = [], batch.column(1).to_pylist()
            for text, template in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if template is not None and template not in known:
                    if len(known) >= HOSTS_HELD:
                        known.clear()
                    known[template] = _load(json.loads(template))
                texts.append(main_text(text or "", known.get(template)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(addresses, pa.string()), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], schema=schema)


def extract(pages, id_column="page_id", address_column="url", html_column="html"):
    """One row per page: id, address, text, n_chars."""
    from pyspark.sql.pandas.types import to_arrow_schema

    types = T.StructType([pages.schema[id_column], T.StructField(address_column, T.StringType()),
                          T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    rows = pages.select(
        F.col(id_column).alias("id"), F.col(address_column).alias("address"), F.col(html_column).cast("string").alias("html"),
        host_of(F.col(address_column)).alias("host"))
    both = rows.join(templates(pages, address_column, html_column), "host", "left")
    return both.select("id", "address", "html", "template").mapInArrow(partial(_extract, schema=to_arrow_schema(types)), types)
