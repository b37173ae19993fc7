"""DataFrame operators: staging, star schema, activity, revenue, funnel, quality."""
