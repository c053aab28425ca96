"""depotkit: demand, inventory and supplier analytics as Spark DataFrame plans."""
