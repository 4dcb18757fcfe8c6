"""DataFrame-to-DataFrame operators. They take column names, so any table can be passed."""
