"""Import every module that registers driver queries."""


def load() -> None:
    from strata.plans import layer_queries, queries, sink_queries  # noqa: F401
