"""What an executed plan and its tasks say of themselves."""


def nodes(df):
    """The operators of the final plan of ``df``, which is run here, as JVM objects."""
    df.collect()
    todo, out = [df._jdf.queryExecution().executedPlan()], []
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            out.append(node)
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
    return out


def named(df, name):
    return [n for n in nodes(df) if n.nodeName().startswith(name)]


def metric(node, name):
    found = node.metrics().get(name)
    return found.get().value() if found.isDefined() else None


def rows_shuffled(df):
    return [metric(n, "shuffleRecordsWritten") for n in named(df, "Exchange")]


def bytes_read(spark, run):
    """Bytes of input that the tasks of ``run`` read, and what it returns."""
    context = spark.sparkContext
    context.setJobGroup("measured", "measured")
    try:
        result = run()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    context._jsc.sc().listenerBus().waitUntilEmpty()
    store, tracker = context._jsc.sc().statusStore(), context.statusTracker()
    stages = {s for job in tracker.getJobIdsForGroup("measured") for s in tracker.getJobInfo(job).stageIds}
    done = [store.lastStageAttempt(s) for s in stages]
    return sum(s.inputBytes() for s in done), result
