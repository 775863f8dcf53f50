"""Order status codes of the sales header."""

from __future__ import annotations

# Status code, label, count column, amount column.
STATUS_CODES = [
    (1, "In process", "trproceso", "mntproceso"),
    (2, "Approved", "traprobadas", "mntaprobadas"),
    (3, "Backordered", "tratrasadas", "mntatrasadas"),
    (4, "Rejected", "trrechazadas", "mntrechazadas"),
    (5, "Shipped", "trenviadas", "mntenviadas"),
    (6, "Cancelled", "trcanceladas", "mntcanceladas"),
]

SHIPPED = 5

