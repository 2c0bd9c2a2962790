"""Planning: ranges, rendered SQL, view shapes, plan reports."""
