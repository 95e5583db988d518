"""Expression library; nothing here touches a session or a row.

``normal`` and ``student`` give SQL text over column names, for ``selectExpr``
and ``F.expr``: a formula with dozens of operators then reaches the JVM in one
call.  ``scalars`` works on Column objects.
"""
