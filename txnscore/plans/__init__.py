"""Plans: named queries over the driver tables, the ML feature/model stages and jobs."""
