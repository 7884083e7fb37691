"""Jobs and the query registry (imported lazily: ``thermograph.plans.catalog``,
``thermograph.plans.stats``, ``thermograph.plans.generate``)."""
