"""Models: staging, star schema, reporting views, dashboard reports."""
