"""usagelens — mobile-network usage insights as Spark DataFrame jobs.

Three products are built from call, SMS and data-volume records, a
subscriber file and two catalogues (rate plans, locations):

* ``plans.activity.activity_snapshot``  — per-subscriber activity (P1)
* ``plans.trends.rate_plan_trends``     — top / least five rate plans (P2)
* ``plans.network.network_activity``    — top / least five countries (P3)

Everything is expressed with the DataFrame API so Catalyst plans it:
partial aggregation before every shuffle, lookups whose join AQE picks by size,
``WindowGroupLimit`` top-k, one pivot per product.
"""

__all__ = ["session", "schemas", "sources", "functions", "operators", "plans", "sinks"]
