"""Compositions: the cleaning stage, the KPI suite, report tables, the export run."""
