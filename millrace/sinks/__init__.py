"""Writers: warehouse tables, load history, text reports."""
