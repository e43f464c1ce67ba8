"""DataFrame-to-DataFrame operators over sales, inventory and calendar."""
