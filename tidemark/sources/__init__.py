"""Messages, tables, relational store and the shared scratch folder."""
