"""What a query that has run has read."""


def scans(df):
    """The scans of files of a query that has been computed: their description and the rows they gave."""
    found = []

    def visit(plan):
        name = plan.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return visit(plan.executedPlan())
        if name.endswith("QueryStageExec"):
            return visit(plan.plan())
        if name == "ReusedExchangeExec":
            return visit(plan.child())
        if name == "FileSourceScanExec":
            roots = plan.relation().location().rootPaths().mkString(" ")
            found.append((f"{plan.simpleString(10_000)} from {roots}", plan.metrics().apply("numOutputRows").value()))
        children = plan.children()
        for number in range(children.size()):
            visit(children.apply(number))

    visit(df._jdf.queryExecution().executedPlan())
    return found
