"""Selectors over the node arrays of `html_nodes`, as built-in higher-order functions.

A test is a function from a node to a Boolean column. Everything stays inside the row: no node
is ever shuffled. All functions return NULL (or an empty array) where nothing is found.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.maps import let
from ..functions.text import strip, strip_each


def page_nodes() -> Column:
    return F.col("nodes")


def page_texts() -> Column:
    return F.col("texts")


# -- tests ---------------------------------------------------------------------
def tag(name):
    return lambda n: n["tag"] == name


def has_class(*names):
    """One of the names is one of the element's classes."""
    return lambda n: reduce(
        lambda a, b: a | b, [F.contains(n["class_raw"], F.lit(f" {name} ")) for name in names]
    )


def class_is(*values):
    """The whole class attribute is one of the values."""
    return lambda n: n["class_raw"].isin(*[f" {value} " for value in values])


def classes(node: Column) -> Column:
    return F.split(F.btrim(node["class_raw"]), " ")


def has_id(value):
    return lambda n: n["elem_id"] == value


def has_token(name, token):
    """The attribute, split at white space, contains the token."""
    return lambda n: F.array_contains(F.split(n["attrs"][name], r"\s+"), token)


def sole_string(*values):
    """The element's only content is exactly one of these strings."""
    return lambda n: n["own_string"].isin(*values)


def sole_string_starts(*prefixes):
    return lambda n: reduce(
        lambda a, b: a | b, [F.startswith(n["own_string"], F.lit(p)) for p in prefixes]
    )


def both(*tests):
    return lambda n: reduce(lambda a, b: a & b, [t(n) for t in tests])


# -- navigation ----------------------------------------------------------------
def all_nodes(nodes: Column, *tests) -> Column:
    return F.filter(nodes, both(*tests))


def first_node(nodes: Column, *tests) -> Column:
    return F.get(all_nodes(nodes, *tests), F.lit(0))


def inside(nodes: Column, node: Column) -> Column:
    """The page's nodes below `node`; `nodes` must be the page's whole array."""
    return let(node, lambda n: F.slice(nodes, n["id"] + 2, n["end"] - n["id"]))


def after(nodes: Column, node: Column) -> Column:
    """The page's nodes that start after `node` does."""
    return let(node, lambda n: F.slice(nodes, n["id"] + 2, F.size(nodes)))


def next_sibling(nodes: Column, node: Column, *tests) -> Column:
    return let(
        node,
        lambda n: first_node(after(nodes, n), lambda m: m["parent"] == n["parent"], *tests),
    )


def each_inside(nodes: Column, found: Column, fields) -> Column:
    """`fields(node, below)` of every found node, `below` being the nodes under it.

    One slice lives at a time, however many of the found nodes lie within each other.
    """
    return F.transform(found, lambda n: let(inside(nodes, n), lambda below: fields(n, below)))


def attr(node: Column, name: str) -> Column:
    return node["attrs"][name]


# -- text ----------------------------------------------------------------------
def _runs(texts, node):
    return let(node, lambda n: F.slice(texts, n["text_from"] + 1, n["text_to"] - n["text_from"]))


def raw_text(texts: Column, node: Column) -> Column:
    """All text runs joined with nothing."""
    return F.array_join(_runs(texts, node), "")


def tight_text(texts: Column, node: Column) -> Column:
    """Each run stripped, joined with nothing."""
    return F.array_join(strip_each(_runs(texts, node)), "")


def spaced_text(texts: Column, node: Column) -> Column:
    """Runs joined with a blank, then stripped as a whole."""
    return strip(F.array_join(_runs(texts, node), " "))


def word_text(texts: Column, node: Column) -> Column:
    """Each run stripped, blank ones left out, joined with one blank."""
    return F.array_join(F.filter(strip_each(_runs(texts, node)), lambda t: t != ""), " ")


# -- labelled fields -----------------------------------------------------------
def labelled_value(nodes: Column, texts: Column, label_tests, value_tests) -> Column:
    """`(labelled, value)`: text of the first value element that follows the label as its sibling."""
    return let(
        first_node(nodes, *label_tests),
        lambda label: F.struct(
            label.isNotNull().alias("labelled"),
            tight_text(texts, next_sibling(nodes, label, *value_tests)).alias("value"),
        ),
    )


def labelled_section(nodes: Column, texts: Column, section_tests, label_tests, value_tests, labels) -> Column:
    """Value text of the first section whose label, stripped, is one of `labels`."""
    sections = each_inside(
        nodes,
        all_nodes(nodes, *section_tests),
        lambda _, below: F.struct(
            tight_text(texts, first_node(below, *label_tests)).alias("label"),
            tight_text(texts, first_node(below, *value_tests)).alias("value"),
        ),
    )
    return F.get(F.filter(sections, lambda s: s["label"].isin(*labels)), F.lit(0))["value"]


def next_anchor(nodes: Column, node: Column) -> Column:
    """First `a` that starts after `node` does, wherever it is."""
    return first_node(after(nodes, node), tag("a"))
