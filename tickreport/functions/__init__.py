"""Sub-package of tickreport."""
