from taxograph.plans.pipelines import main

main()
