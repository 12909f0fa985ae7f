"""The stages from raw tables to reports."""
