"""listingflow: vehicle-catalogue and used-car-listing jobs as Spark DataFrame plans."""
