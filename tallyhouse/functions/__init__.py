"""Column helpers: plain functions from columns to columns, no UDFs."""
