"""Jobs: what the operators do together, from landed data to tables and reports."""
