"""crewlens: workforce analytics as lazy Spark DataFrame plans."""
