"""Account intelligence on Spark: resolve product, CRM and vendor data into one account view."""
