"""Physical-plan checks used by the tests (scale hygiene)."""

from __future__ import annotations


def _children(node):
    ch = node.children()
    return [ch.apply(i) for i in range(ch.size())]


def _plan(df):
    p = df._jdf.queryExecution().executedPlan()
    if p.nodeName() == "AdaptiveSparkPlan":
        p = p.initialPlan()
    return p


def walk(node):
    yield node
    for c in _children(node):
        yield from walk(c)


AGGREGATES = ("HashAggregate", "ObjectHashAggregate", "SortAggregate")


def single_partition_violations(df) -> list[str]:
    """Exchanges into a single partition whose input is not an aggregate's
    output (i.e. raw rows funnelled into one task)."""
    bad = []
    for n in walk(_plan(df)):
        if n.nodeName() == "Exchange" and "SinglePartition" in n.toString().split("\n")[0]:
            child = _children(n)[0]
            name = child.nodeName()
            # look through projections / filters to the producing operator
            while name in ("Project", "Filter", "WholeStageCodegen", "InputAdapter") and _children(child):
                child = _children(child)[0]
                name = child.nodeName()
            if not any(name.startswith(a) for a in AGGREGATES):
                bad.append(name)
    return bad


def python_udf_nodes(df) -> list[str]:
    return [n.nodeName() for n in walk(_plan(df))
            if n.nodeName() in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                                "MapInPandas")]


def plan_summary(df) -> dict:
    """Counts of the operators that matter for scale in a physical plan."""
    root = _plan(df)
    nodes = list(walk(root))
    names = [n.nodeName() for n in nodes]
    scans = []
    for n in nodes:
        if n.nodeName().startswith("Scan"):
            text = n.toString()
            rs = text.split("ReadSchema: ")[-1].split("\n")[0] if "ReadSchema" in text else ""
            pf = text.split("PushedFilters: ")[-1].split(",")[0] if "PushedFilters" in text else ""
            scans.append({"scan": text.split("\n")[0][:60], "read_schema": rs[:120], "pushed_filters": pf[:80]})
    single = sum(1 for n in nodes if n.nodeName() == "Exchange" and "SinglePartition" in n.toString().split("\n")[0])
    return {
        "exchanges": names.count("Exchange"),
        "single_partition_exchanges": single,
        "broadcast_exchanges": names.count("BroadcastExchange"),
        "joins": {k: names.count(k) for k in ("BroadcastHashJoin", "ShuffledHashJoin", "SortMergeJoin",
                                                 "BroadcastNestedLoopJoin", "CartesianProduct") if names.count(k)},
        "windows": names.count("Window"),
        "python_nodes": len(python_udf_nodes(df)),
        "scans": scans,
    }
