"""DataFrame -> DataFrame operators, shared by batch queries and streams.

``decode`` (F1-F4, X1, S6 decode), ``events`` (F5, F7, T4, J1), ``sessions``
(T2, A1-A3), ``summaries`` (A4, A5), ``funnel`` (A8-A10), ``gold`` (A6, A7),
``serving`` (F9, A11-A13, J2), ``maintenance`` (X4, X5).
"""
