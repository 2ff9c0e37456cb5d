"""Which tables a SQL text reads, and where their names stand in it, from
Spark's own parser (SURVEY §2.1, S11)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _items(sequence) -> list:
    return [sequence.apply(k) for k in range(sequence.size())]


def _kind(node) -> str:
    return node.getClass().getSimpleName()


def table_references(spark: SparkSession, text: str) -> list[tuple[int, int, str]]:
    """(start, stop, name) of every relation that the text reads, in order,
    subqueries included; ``text[start:stop]`` is the name as written. Names
    that a WITH clause gives are no tables within its reach; inside its own
    definition such a name is one, unless the clause is recursive."""
    found: set[tuple[int, int, str]] = set()

    def expression(node, scope: frozenset[str]) -> None:
        if "PlanExpression" in _superclasses(node):
            plan(node.plan(), scope)
        for child in _items(node.children()):
            expression(child, scope)

    def plan(node, scope: frozenset[str]) -> None:
        kind = _kind(node)
        if kind == "UnresolvedWith":
            for relation in _items(node.cteRelations()):
                name = relation._1().lower()
                plan(relation._2(), scope | {name} if node.allowRecursion() else scope)
                scope = scope | {name}
        if kind == "UnresolvedRelation":
            parts = _items(node.multipartIdentifier())
            if len(parts) > 1 or parts[0].lower() not in scope:
                origin = node.origin()
                found.add((origin.startIndex().get(), origin.stopIndex().get() + 1, ".".join(parts)))
        for item in _items(node.expressions()):
            expression(item, scope)
        for child in _items(node.children()):
            plan(child, scope)

    plan(spark._jsparkSession.sessionState().sqlParser().parsePlan(text), frozenset())
    return sorted(found)


def _superclasses(node) -> set[str]:
    """Simple names of a node's class and those above it."""
    names, kind = set(), node.getClass()
    while kind is not None:
        names.add(kind.getSimpleName())
        kind = kind.getSuperclass()
    return names
