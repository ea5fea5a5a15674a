"""baobab: commerce-data analytics operators on Apache Spark.

Entry points:

- ``baobab.operators`` -- DataFrame -> DataFrame operators: ``cleaning``,
  ``quality``, ``kpi``, ``joins`` (audits), ``funnel``, ``ranking``, ``text``.
- ``baobab.sources`` -- CSV / JSON / text readers, JDBC read / write /
  publish, temp views.
- ``baobab.streaming`` -- the cleaning chain on a stream.
- ``baobab.plans.views.register_commerce_views`` -- the course's tables as
  SQL views; ``baobab.plans.catalog.registry`` -- the registered queries.
- ``baobab.session.build_session`` -- a session with the library's settings.
"""

__version__ = "0.1.0"
