"""Rows that the scans of an executed frame have read."""


def _nodes(plan):
    yield plan
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        yield from _nodes(plan.executedPlan())
    elif name.endswith("QueryStageExec"):
        yield from _nodes(plan.plan())
    children = plan.children()
    for i in range(children.size()):
        yield from _nodes(children.apply(i))


def rows_read(df, folder):
    """(rows, files) read below `folder` when `df` was last run."""
    rows = files = 0
    for node in _nodes(df._jdf.queryExecution().executedPlan()):
        if (node.getClass().getSimpleName() == "FileSourceScanExec"
                and folder in node.relation().location().rootPaths().mkString(",")):
            metrics = node.metrics()
            rows += metrics.apply("numOutputRows").value()
            files += metrics.apply("numFiles").value()
    return rows, files
